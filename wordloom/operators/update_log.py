"""A log of attribute updates: numbered batches, the last writer of a value wins.

Each batch is written under its number with the values it sets; attributes that a batch does
not name stay as they are, and a value set to null is null. Reading a corpus through the log
joins it once with the last value of every (document, attribute), however many batches there
are: as if the batches had been applied one by one in the order of their numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wordloom.sizing import join_by_key, unique_size
from wordloom.sources.corpus import Corpus


@dataclass(frozen=True)
class UpdateLog:
    """Batches of updates under a folder, for the keys and attributes of one corpus."""

    path: str
    corpus: Corpus

    def _schema(self) -> T.StructType:
        kinds = self.corpus.df.schema
        fields = [kinds[k] for k in self.corpus.keys]
        for attr in self.corpus.attrs:
            value = T.StructType([T.StructField("value", kinds[attr].dataType)])
            fields.append(T.StructField(attr, value))
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def append(self, batch: int, updates: DataFrame, attrs: Sequence[str]) -> None:
        """Write a batch: ``updates`` has the keys, each once, and every attribute in ``attrs``;
        a list replaces the whole list. A number can be written once."""
        if batch < 0:
            raise ValueError("a batch number is negative")
        unknown = set(attrs) - set(self.corpus.attrs)
        if unknown:
            raise ValueError(f"no such attributes: {sorted(unknown)}")
        kinds = self.corpus.df.schema
        for attr in attrs:
            listed = isinstance(updates.schema[attr].dataType, T.ArrayType)
            if listed != isinstance(kinds[attr].dataType, T.ArrayType):
                raise ValueError(f"values of {attr} are {'' if listed else 'not '}lists")
        unique_size(updates.select(*self.corpus.keys), self.corpus.keys)
        columns = [F.col(k) for k in self.corpus.keys]
        for field in self._schema().fields[len(self.corpus.keys) :]:
            value = F.lit(None)
            if field.name in attrs:
                kind = kinds[field.name].dataType
                value = F.struct(F.col(field.name).cast(kind).alias("value"))
            columns.append(value.cast(field.dataType).alias(field.name))
        updates.select(*columns).write.mode("error").parquet(f"{self.path}/batch={batch}")

    def batches(self, upto: int | None = None) -> DataFrame:
        """All rows of the log, or those of batches up to a number, with ``batch``."""
        spark: SparkSession = self.corpus.df.sparkSession
        schema = self._schema().add("batch", T.IntegerType())
        rows = spark.read.schema(schema).option("basePath", self.path).parquet(self.path)
        return rows if upto is None else rows.where(F.col("batch") <= upto)

    def latest(self, upto: int | None = None) -> DataFrame:
        """The last value of each attribute of each document that the log names, as a struct
        that is null where no batch sets the attribute. Combined before its one shuffle."""
        last = [
            F.max_by(attr, F.when(F.col(attr).isNotNull(), F.col("batch"))).alias(attr)
            for attr in self.corpus.attrs
        ]
        return self.batches(upto).groupBy(*self.corpus.keys).agg(*last)

    def overlaid(self, upto: int | None = None) -> Corpus:
        """The corpus as the log leaves it, or left it after batch ``upto``. Ids that the corpus
        lacks change nothing."""
        keys = list(self.corpus.keys)
        side = self.latest(upto).withColumnsRenamed({a: f"__{a}" for a in self.corpus.attrs})
        joined = join_by_key(self.corpus.df, side, keys, "left")
        values = {
            a: F.when(F.col(f"__{a}").isNotNull(), F.col(f"__{a}")["value"]).otherwise(F.col(a))
            for a in self.corpus.attrs
        }
        return replace(self.corpus, df=joined.withColumns(values).select(*self.corpus.df.columns))

    def updated_counts(self) -> DataFrame:
        """(batch, updated): documents of the corpus that each batch reaches, zero included."""
        ids = self.corpus.df.select(*self.corpus.keys, F.lit(1).alias("__known"))
        rows = self.batches().select("batch", *self.corpus.keys)
        found = rows.join(ids, list(self.corpus.keys), "left")
        return found.groupBy("batch").agg(F.count("__known").alias("updated"))
