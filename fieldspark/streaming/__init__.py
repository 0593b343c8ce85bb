"""The row-wise form plans over a streaming source."""
