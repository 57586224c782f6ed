"""No streaming operators: every source is a batch of files and every product a whole table.

The row-wise operators (flag masks, harmonic climatology, depth bins, dimension
joins) are plain DataFrame transformations and also accept a streaming frame.
"""
