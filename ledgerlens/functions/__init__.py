"""functions"""
