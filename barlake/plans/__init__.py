from barlake.plans.market import Market

__all__ = ["Market"]
