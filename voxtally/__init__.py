"""voxtally: voxel, cell and region analytics for labelled 3-D volumes on Spark."""

__version__ = "0.1.0"
