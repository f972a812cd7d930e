"""packloom.sources"""
