"""Operators of a training-data pipeline: archives, packing, near copies, quality, secrets, licences."""
