"""mercato.plans"""
