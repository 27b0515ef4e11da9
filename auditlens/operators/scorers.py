"""Scorers: a model as a plan.

``score(df)`` adds a ``score`` column. Explanation operators overwrite feature columns and
call it again, so the same code serves closed-form expressions and fitted Spark ML models.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LinearSVCModel, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.expr import clip, is_numeric, sigmoid
from auditlens.operators.boosted import encoded_inputs, fitted_trees, margin_column


class ExprScorer:
    """Scorer given by a Column expression over named inputs."""

    def __init__(self, inputs: list[str], fn: Callable[[dict[str, Column]], Column]):
        self.inputs = list(inputs)
        self.fn = fn

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("score", self.fn({c: F.col(c) for c in self.inputs}))


class AdditiveScorer(ExprScorer):
    """Scorer that is an intercept plus one term per input."""

    def __init__(self, inputs, terms: Callable[[dict[str, Column]], dict[str, Column]], intercept: float):
        self.terms = terms
        self.intercept = intercept
        super().__init__(inputs, self._total)

    def _total(self, cols: dict[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for term in self.terms(cols).values():
            total = total + term
        return total


class MLScorer:
    """Scorer backed by a fitted Spark ML model.

    ``output`` "score" is the positive-class probability if the model yields one, else the sigmoid
    of its raw margin, else the prediction itself (a regression value or a degenerate 0/1 score).
    ``output`` "margin" is the log-odds scale: the raw margin of a linear classifier, twice that of
    boosted trees (whose logistic loss is over labels -1 and 1), the logit of a probability otherwise.
    Boosted trees behind the library's own encoding are scored batch by batch (``boosted``), any other
    pipeline by its stages.
    """

    def __init__(self, model: PipelineModel, inputs: list[str], output: str = "score"):
        if output not in ("score", "margin"):
            raise ValueError(f"output is 'score' or 'margin', not {output!r}")
        self.model = model
        self.inputs = list(inputs)
        self.output = output
        self._encoded = encoded_inputs(model)
        self._trees = None
        if self._encoded:
            numeric, texts = self._encoded
            self._trees = fitted_trees(model.stages[-1], len(numeric), [len(v) for v in texts.values()])

    def _boosted_margin(self, df: DataFrame) -> Column | None:
        """Raw margin of boosted trees, if their inputs are plain columns of ``df``."""
        if self._trees is None:
            return None
        numeric, texts = self._encoded
        types = {f.name: f.dataType for f in df.schema.fields}
        if not {*numeric, *texts} <= types.keys() or not all(is_numeric(types[c]) for c in numeric):
            return None
        return margin_column(self._trees, numeric, texts)

    def _margin(self, made: list[str]) -> Column:
        last = self.model.stages[-1]
        if isinstance(last, (GBTClassificationModel, LogisticRegressionModel, LinearSVCModel)):
            raw = vector_to_array(F.col(last.getRawPredictionCol()))[1]
            return raw * 2.0 if isinstance(last, GBTClassificationModel) else raw
        if "probability" not in made:
            raise ValueError("a model without probabilities has no margin")
        p = vector_to_array(F.col("probability"))[1]
        return F.log(p / (1.0 - p))

    def score(self, df: DataFrame) -> DataFrame:
        margin = self._boosted_margin(df)
        if margin is not None:
            value = margin * 2.0 if self.output == "margin" else 1.0 - sigmoid(margin * -2.0)
            return df.withColumn("score", value).select(*[c for c in df.columns if c != "score"], "score")
        out = self.model.transform(df)
        made = [c for c in out.columns if c not in df.columns]
        if self.output == "margin":
            value = self._margin(made)
        elif "probability" in made:
            value = vector_to_array(F.col("probability"))[1]
        elif "rawPrediction" in made:
            value = sigmoid(vector_to_array(F.col("rawPrediction"))[1])
        else:
            value = F.col("prediction")
        return out.withColumn("score", value).select(*[c for c in df.columns if c != "score"], "score")


def heuristic_score(dti: str = "dti", delinq: str = "delinq_2yrs", income: str = "annual_inc") -> Column:
    """Fallback score when no model score exists: 0.1 dti + 0.2 delinquencies - 0.1 income/100000,
    clipped to [0, 1]. Missing values must be filled before."""
    raw = F.col(dti) * 0.1 + F.col(delinq) * 0.2 - F.col(income) / 100000 * 0.1
    return clip(raw, 0.0, 1.0)
