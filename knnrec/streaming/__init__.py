"""No streaming operators.

The rating predictor has no stream source, watermark, window or state to
rebuild, so nothing lives here. A stream of rating requests would be scored
per micro-batch by ``knnrec.operators.predict.score_pairs`` against a fitted
model; that needs no operator of its own.
"""
