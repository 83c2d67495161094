"""trellis.sources"""
