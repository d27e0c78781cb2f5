"""weblex.streaming"""
