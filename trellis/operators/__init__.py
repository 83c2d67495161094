"""trellis.operators"""
