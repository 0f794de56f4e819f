"""feedloom.plans"""
