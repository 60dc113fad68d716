"""Measures that are defined once and asked for over any of their dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.orders import MONEY


@dataclass(frozen=True)
class MetricView:
    """Named dimensions and measures over one source, as SQL expressions. Synonyms stand for measure names."""

    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    synonyms: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def measure_name(self, name: str) -> str:
        if name in self.measures:
            return name
        for measure, others in self.synonyms.items():
            if name.lower() in (other.lower() for other in others):
                return measure
        raise ValueError(f"no measure {name!r}; known: {sorted(self.measures)}")

    def _dimension(self, name: str) -> Column:
        if name not in self.dimensions:
            raise ValueError(f"no dimension {name!r}; known: {sorted(self.dimensions)}")
        return F.expr(self.dimensions[name]).alias(name)

    def query(self, source: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
        """The measures for each combination of the dimensions ``by``, or one total row."""
        if not measures:
            raise ValueError("ask for at least one measure")
        names = [self.measure_name(name) for name in measures]
        wanted = [F.expr(self.measures[name]).alias(name) for name in names]
        return source.groupBy(*[self._dimension(name) for name in by]).agg(*wanted)


SALES_METRICS = MetricView(
    dimensions={"order_date": "o_orderdate", "order_status": "order_status"},
    measures={
        "total_revenue": "sum(o_totalprice)",
        "avg_order_value": f"cast(sum(o_totalprice) / count(o_totalprice) as {MONEY})",
    },
    # The other names under which consumers ask for these measures.
    synonyms={"total_revenue": ["sales", "income", "turnover"], "avg_order_value": ["AOV", "basket size"]},
)
