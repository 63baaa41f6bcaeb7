"""mercato.operators"""
