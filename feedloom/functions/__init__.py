"""feedloom.functions"""
