"""Automatic encoding of a mixed table as a Spark ML stage: fit on train, apply anywhere, save, load."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.operators.encode import ONE_HOT_LIMIT, fit_categories, hot_columns
from auditlens.operators.profile import bounded_distinct_counts
from auditlens.operators.topics import TopicModel, fit_topics


class _Shared(Params):
    """Columns and limits of the encoder."""

    numeric = Param(Params._dummy(), "numeric", "columns that pass as they are", TypeConverters.toListString)
    text = Param(Params._dummy(), "text", "columns that are encoded by their number of values", TypeConverters.toListString)
    limit = Param(Params._dummy(), "limit", "values from which a text column gets topics", TypeConverters.toInt)
    topics = Param(Params._dummy(), "topics", "topics per wide text column", TypeConverters.toInt)
    iterations = Param(Params._dummy(), "iterations", "most rounds of the topic fit", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the topic fit", TypeConverters.toInt)
    outputCol = Param(Params._dummy(), "outputCol", "vector column with all encoded columns", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numeric=[], text=[], limit=ONE_HOT_LIMIT, topics=30, iterations=20, seed=42, outputCol="encoded")


class TableEncoder(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers pass; texts below ``limit`` values of the training rows become 0/1 columns, the others
    topic weights of their character n-grams. What is learned is categories and topics, so other rows
    get the same columns: an unknown category is all 0, an unknown dirty text is encoded like any."""

    @keyword_only
    def __init__(self, *, numeric=None, text=None, limit=ONE_HOT_LIMIT, topics=30, iterations=20, seed=42, outputCol="encoded"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TableEncoderModel:
        text, limit = self.getOrDefault("text"), self.getOrDefault("limit")
        counts = bounded_distinct_counts(dataset, text, limit) if text else {}
        narrow = [c for c in text if counts[c] < limit]
        options = {k: self.getOrDefault(k) for k in ("topics", "iterations", "seed")}
        found = {c: fit_topics(dataset, c, **options) for c in text if c not in narrow}
        state = {"categories": fit_categories(dataset, narrow), "topics": {c: m.state() for c, m in found.items()}}
        model = TableEncoderModel()
        self._copyValues(model)
        return model._set(state=json.dumps(state))


class TableEncoderModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted encoder. Its whole state is a parameter, so the usual readers and writers keep it."""

    state = Param(Params._dummy(), "state", "learned categories and topics as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(state='{"categories": {}, "topics": {}}')

    def learned(self) -> tuple[dict[str, list[str]], dict[str, TopicModel]]:
        state = json.loads(self.getOrDefault("state"))
        return state["categories"], {c: TopicModel.from_state(s) for c, s in state["topics"].items()}

    def columns(self) -> list[str]:
        """Names of the encoded columns, in the order of the vector."""
        categories, topics = self.learned()
        hot = [f"{c}_{v}" for c, values in categories.items() for v in values]
        return [*self.getOrDefault("numeric"), *hot, *[f"{c}_topic_{i}" for c, m in topics.items() for i in range(len(m.matrix))]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        categories, topics = self.learned()
        out = dataset
        for c, model in topics.items():
            out = model.encode(out, c)
        out = out.withColumns(hot_columns(categories))
        values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in self.columns()]
        return out.withColumn(self.getOrDefault("outputCol"), array_to_vector(F.array(*values)))
