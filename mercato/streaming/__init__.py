"""mercato.streaming"""
