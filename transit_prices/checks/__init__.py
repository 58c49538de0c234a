"""checks"""
