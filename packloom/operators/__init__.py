"""packloom.operators"""
