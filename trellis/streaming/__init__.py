"""trellis.streaming"""
