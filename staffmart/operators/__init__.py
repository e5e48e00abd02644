from staffmart.operators import filters, marts, privacy, quality, repair, shape

__all__ = ["filters", "marts", "privacy", "quality", "repair", "shape"]
