"""feedloom.sources"""
