from recengine.sources import fixtures, readers, sinks

__all__ = ["fixtures", "readers", "sinks"]
