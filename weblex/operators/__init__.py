"""weblex.operators"""
