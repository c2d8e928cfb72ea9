"""twinview: product activity and visitor views over click streams, in batch and as a stream."""

__version__ = "0.1.0"
