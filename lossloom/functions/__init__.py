from . import amortization, bounds, dates, delinquency, hashing, normal, rates

__all__ = ["amortization", "bounds", "dates", "delinquency", "hashing", "normal", "rates"]
