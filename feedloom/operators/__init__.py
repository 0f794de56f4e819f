"""feedloom.operators"""
