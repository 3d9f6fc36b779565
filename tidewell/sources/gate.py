"""A write that refuses bad rows: counted while they are written, held back, and a limit that stops the swap.

Rows that break a rule go to their own part of the new table in the one job that writes it, and the
same job counts them. Whether keys are unique is then asked of the stored key column alone. Only a
table within its limits takes the place of the old one; what was held back is stored either way.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewell.operators.lookup import Lookup, lookups
from tidewell.session import stage
from tidewell.sources.sinks import full_refresh, swap_in

RULES = "broken_rules"
_BROKEN, _NONE, _AND, _SOUND = "__broken", "none", "; ", "__sound"


@dataclass(frozen=True)
class Gate:
    """``rules``: name -> whether a row breaks it (NULL: it does not).

    ``unique``: keys that must be filled ("KEY filled") and occur once ("KEY unique", broken by all
    rows of the key). ``allowed``: how many rows may break a rule and be held back; 0 if not named.
    """

    rules: Mapping[str, Column] = field(default_factory=dict)
    unique: tuple[str, ...] = ()
    allowed: Mapping[str, int] = field(default_factory=dict)

    def row_rules(self) -> dict[str, Column]:
        return {**self.rules, **{f"{key} filled": F.col(key).isNull() for key in self.unique}}


class QualityError(Exception):
    """A table was refused; ``found`` has the number of rows that break each rule."""

    def __init__(self, path: str, found: dict[str, int], over: dict[str, int]) -> None:
        broken = ", ".join(f"{n} rows break '{rule}' ({found[rule] - n} too many)" for rule, n in over.items())
        super().__init__(f"{path} is not replaced: {broken}")
        self.found = found


def gated_refresh(
    df: DataFrame, path: str, gate: Gate, quarantine: str, partition_by: tuple[str, ...] = (), **lookup_options
) -> DataFrame:
    """Replace the table at ``path`` by the rows of ``df`` that break no rule, and return it as stored.

    The other rows are stored at ``quarantine``, with the names of the rules they break. If more
    rows than allowed break a rule, the old table stays and a ``QualityError`` tells what was found.
    """
    spark, path, rules = df.sparkSession, path.rstrip("/"), gate.row_rules()
    new = f"{path}__{uuid.uuid4().hex}"
    try:
        seen = Observation()
        counts = [F.count_if(F.coalesce(broken, F.lit(False))).alias(name) for name, broken in rules.items()]
        names = F.concat_ws(_AND, *[F.when(broken, F.lit(name)) for name, broken in rules.items()])
        sound = F.count_if(names == "").alias(_SOUND)
        judged = df.observe(seen, sound, *counts).withColumn(_BROKEN, F.coalesce(F.nullif(names, F.lit("")), F.lit(_NONE)))
        judged.write.partitionBy(_BROKEN, *partition_by).parquet(new)
        found = {name: seen.get[name] for name in rules}
        stored = spark.read.schema(judged.schema).parquet(new)

        repeated: dict[str, DataFrame] = {}
        for key in gate.unique:
            copies = stored.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
            copies = stage(copies.where("key IS NOT NULL AND n > 1"), "repeated-keys")
            found[f"{key} unique"] = copies.agg(F.sum("n")).first()[0] or 0
            if found[f"{key} unique"]:
                repeated[f"{key} unique"] = copies.withColumn("rule", F.lit(f"{key} unique"))

        broken = F.filter(F.split(_BROKEN, _AND, -1), lambda name: name != _NONE)
        if repeated:
            wanted = [Lookup(t, {"key": F.col(name.removesuffix(" unique"))}, {f"__{i}": "rule"}) for i, (name, t) in enumerate(repeated.items())]
            stored = lookups(stored, wanted, **lookup_options)
            more = F.array(*[F.col(f"__{i}") for i in range(len(wanted))])
            broken = F.concat(broken, F.filter(more, lambda name: name.isNotNull()))
        held = stored.where(F.size(broken) > 0)
        full_refresh(held.select(*df.columns, broken.alias(RULES)), quarantine)

        over = {name: n - gate.allowed.get(name, 0) for name, n in found.items() if n > gate.allowed.get(name, 0)}
        if over:
            raise QualityError(path, found, over)
        if repeated or not seen.get[_SOUND]:
            return full_refresh(stored.where(F.size(broken) == 0).select(*df.columns), path, partition_by)
        swap_in(spark, f"{new}/{_BROKEN}={_NONE}", path)
        return spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(new)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
