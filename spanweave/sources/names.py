"""Names of the daily partitions that spans are read from and dependencies are written to."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NameRule:
    """How partitions of a store are named.

    The base names are those of the store in use.  With a prefix there are two candidates, the
    current form `prefix-name` before the legacy form `prefix:name`; without one there is one.  With
    aliases the names carry no date: one alias is read from and one is written to.
    """

    span_base: str = "span"
    dependency_base: str = "dependencies"
    prefix: str = ""
    prefix_marks: tuple[str, ...] = ("-", ":")  # current and legacy; file systems may refuse ":"
    separator: str = "-"
    aliases: bool = False
    type_suffix: bool = False  # old stores keep documents under a type of the partition

    def _prefixes(self) -> list[str]:
        return [self.prefix + mark for mark in self.prefix_marks] if self.prefix else [""]

    def candidates(self, day: dt.date) -> list[tuple[str, str]]:
        """(read, write) names in the order in which they are tried."""
        date = f"{day.year:04d}{self.separator}{day.month:02d}{self.separator}{day.day:02d}"
        read, write = ("read", "write") if self.aliases else (date, date)
        suffix = "/dependencies" if self.type_suffix else ""
        return [
            (f"{p}{self.span_base}-{read}", f"{p}{self.dependency_base}-{write}{suffix}")
            for p in self._prefixes()
        ]

    def candidate_columns(self, day: Column) -> Column:
        """The same names for a column of days: array<struct<read, write>>."""
        date = F.concat_ws(
            self.separator, *[F.date_format(day, part) for part in ("yyyy", "MM", "dd")]
        )
        read, write = (F.lit("read"), F.lit("write")) if self.aliases else (date, date)
        suffix = F.lit("/dependencies" if self.type_suffix else "")
        return F.array(
            *[
                F.struct(
                    F.concat(F.lit(f"{p}{self.span_base}-"), read).alias("read"),
                    F.concat(F.lit(f"{p}{self.dependency_base}-"), write, suffix).alias("write"),
                )
                for p in self._prefixes()
            ]
        )
