"""One registered query and how its result is presented for comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.session import configure

# Sums of doubles differ in the last bits with the order of the rows, so they
# are compared on a grid. A binary grid has no ties with decimal averages.
GRID = 2**30


@dataclass(frozen=True)
class Entry:
    """``floats`` names the columns that come from floating-point sums, ``grid``
    how many steps per unit they are compared on (coarser for large sums)."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    floats: Sequence[str] = ()
    grid: int = GRID

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.run(configure(spark), sf_dir)
        columns = []
        for field in df.schema:
            col = F.col(f"`{field.name}`")
            if field.name in self.floats:
                col = F.rint(col * F.lit(float(self.grid))) / F.lit(float(self.grid))
            elif isinstance(field.dataType, T.TimestampType):
                col = col.cast("timestamp_ntz")
            columns.append(col.alias(field.name))
        return df.select(*columns)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.floats:
            return self.sql
        grid = f"CAST({self.grid} AS DOUBLE)"
        rounded = ", ".join(
            f'round_even("{c}" * {grid}, 0) / {grid} AS "{c}"' for c in self.floats
        )
        return f"SELECT * REPLACE ({rounded}) FROM ({self.sql}) AS result"
