"""feedloom.streaming"""
