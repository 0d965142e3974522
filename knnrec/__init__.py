"""knnrec: user-based k-nearest-neighbour rating prediction on Spark DataFrames.

Every stage is a lazy DataFrame transformation built from Spark SQL
functions; the only actions are the caller's.
"""

from knnrec.plans.exact import KnnModel, fit_exact
from knnrec.plans.approximate import fit_approx
from knnrec.operators.predict import score_pairs
from knnrec.operators.evaluate import mae

__all__ = ["KnnModel", "fit_exact", "fit_approx", "score_pairs", "mae"]
