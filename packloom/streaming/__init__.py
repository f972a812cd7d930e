"""packloom.streaming"""
