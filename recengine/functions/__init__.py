from recengine.functions import arrays, columns

__all__ = ["arrays", "columns"]
