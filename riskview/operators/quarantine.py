"""Values that cannot enter silver as they are: set aside as rows and counted.

A record is *corrupt* if it could not be parsed, and a text value is *miscast*
if it is no value of the type that silver gives its column (silver holds NULL
there).  Both leave one row with the original text; the counts are observed in
the same pass, which reads only the columns it judges and the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class QuarantineError(ValueError):
    """More corrupt or miscast values in a column than a run may have."""


def set_aside(df: DataFrame, types: Mapping[str, str], corrupt: str | None = None,
              keys: Sequence[str] = (), carry: Sequence[str] = ()) -> tuple[DataFrame, Observation, list[str]]:
    """The bad values of ``df``, the observation that counts them, and the
    judged columns.

    The rows are ``column_name, value, key`` (the key columns as JSON) and the
    columns named by ``carry``.  ``types`` gives the type of each text column
    that is cast; ``corrupt`` names the column that holds the text of unparsed
    records, whose other columns are not judged.  Write the rows once, then
    read the counts with ``tally``.  NULL is a value of every type; an empty
    text is none of a number, date or timestamp.
    """
    parsed = F.lit(True) if corrupt is None else F.col(corrupt).isNull()
    wrong = {} if corrupt is None else {corrupt: F.col(corrupt).isNotNull()}
    for c, t in types.items():
        wrong[c] = parsed & F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
    present = [c for c in dict.fromkeys([*keys, *carry]) if c in df.columns]
    key = F.to_json(F.struct(*[c for c in keys if c in present])) if set(keys) & set(present) else F.lit(None).cast("string")
    seen = Observation()
    rows = (df.select(*dict.fromkeys([*wrong, *present]))
            .observe(seen, F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(bad).alias(f"bad_{i}") for i, bad in enumerate(wrong.values())]))
    cells = F.array(*[F.when(bad, F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
                      for c, bad in wrong.items()])
    rows = rows.select(F.inline(F.filter(cells, lambda x: x.isNotNull())), key.alias("key"),
                       *[c for c in carry if c in present])
    return rows, seen, list(wrong)


def tally(seen: Observation, columns: Sequence[str]) -> list[tuple[str, int, int]]:
    """``(column, rows, bad)`` of a written ``set_aside``."""
    found = seen.get
    return [(c, found.get("rows", 0), found.get(f"bad_{i}", 0)) for i, c in enumerate(columns)]


def judge(counts: Sequence[tuple[str, int, int]], most_bad: float, table: str) -> None:
    """Raise if more than the share ``most_bad`` of a column's rows is bad."""
    over = [f"{c} {bad} of {rows}" for c, rows, bad in counts if bad > most_bad * rows]
    if over:
        raise QuarantineError(f"{table}: {', '.join(over)} corrupt or miscast")
