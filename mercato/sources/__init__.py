"""mercato.sources"""
