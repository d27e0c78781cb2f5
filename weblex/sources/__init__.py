"""weblex.sources"""
