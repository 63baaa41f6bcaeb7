"""mercato.functions"""
