"""Stages that others can plug in: map stages rewrite a context, propose stages make proposals from it, filter stages edit these.

A stage is a function of DataFrames. Stages run in order of registration; the
proposals of all propose stages are joined into one table, each named by its
stage, so that one plan holds them all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PHASES = ("map", "propose", "filter")


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable
    phase: str
    tags: tuple[str, ...] = ()


@dataclass
class Stages:
    """A registry. A name that is taken keeps its first stage."""

    held: dict[str, Stage] = field(default_factory=dict)

    def register(self, name: str, run: Callable, tags: tuple[str, ...] = (), phase: str = "propose") -> Stages:
        if phase not in PHASES:
            raise ValueError(f"phase {phase} is none of {', '.join(PHASES)}")
        self.held.setdefault(name, Stage(name, run, phase, tuple(tags)))
        return self

    def unregister(self, name: str) -> None:
        self.held.pop(name, None)

    def of(self, phase: str) -> list[Stage]:
        return [s for s in self.held.values() if s.phase == phase]

    def context(self, df: DataFrame) -> DataFrame:
        for stage in self.of("map"):
            df = stage.run(df)
        return df

    def propose(self, df: DataFrame, policy: Column | None = None) -> DataFrame:
        """All proposals on the mapped context, with origin and tags, after all filters; those that fail the policy are left out.

        A propose stage returns rows with ``action`` (null: no proposal); a filter stage
        is a function of (proposals, context).
        """
        context = self.context(df)
        found = None
        for stage in self.of("propose"):
            tags = F.array(*[F.lit(t) for t in stage.tags]).cast("array<string>")
            rows = stage.run(context).where("action IS NOT NULL").withColumns({"action": F.upper("action"), "origin": F.lit(stage.name), "tags": tags, "score": F.lit(0.5)})
            found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
        if found is None:
            return context.limit(0).withColumns({"action": F.lit(None).cast("string"), "origin": F.lit(None).cast("string"), "tags": F.array().cast("array<string>"), "score": F.lit(0.5)})
        for stage in self.of("filter"):
            found = stage.run(found, context)
        return found if policy is None else found.where(F.coalesce(policy, F.lit(False)))


def route(plan: str, key: list[str]) -> Callable:
    """A filter stage: proposals of a planned action or that set plans; all of a context's proposals where it has no plan or none would be left."""
    from pyspark.sql import Window

    def run(proposals: DataFrame, _: DataFrame) -> DataFrame:
        ok = F.coalesce(F.array_contains(plan, F.col("action")), F.lit(False)) | F.col("action").isin("SET_PLAN", "SET_MODE")
        rows = proposals.withColumn("__ok", ok).withColumn("__any", F.max(F.when(F.col("__ok"), 1).otherwise(0)).over(Window.partitionBy(*key)))
        return rows.where(F.col(plan).isNull() | (F.size(plan) == 0) | F.col("__ok") | (F.col("__any") == 0)).drop("__ok", "__any")

    return run


def attend(tags: str) -> Callable:
    """A filter stage: adds to a proposal's score a tenth of the share of the context's tags that its stage has."""

    def run(proposals: DataFrame, _: DataFrame) -> DataFrame:
        shared = F.size(F.array_intersect("tags", F.col(tags))) / F.greatest(F.size(tags), F.lit(1))
        return proposals.withColumn("score", F.col("score") + F.when(F.size(tags) > 0, 0.1 * shared).otherwise(0.0))

    return run
