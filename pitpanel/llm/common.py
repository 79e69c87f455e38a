"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes handled at once inside a Python task.
CHUNK_BYTES = 1 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has, in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def at(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def sheltered(
    docs: DataFrame, names: Sequence[str], work: Callable[..., DataFrame], added: Sequence[str] = ()
) -> DataFrame:
    """``work`` on ``docs`` under column names that nothing inside it can clash with.

    ``work`` takes the renamed rows and the new names of ``names``, and returns all of
    the rows' columns in order, then those in ``added``. Names are given back at the end.
    """
    safe = [f"input_{i}" for i in range(len(docs.columns))]
    place = {c.lower(): s for c, s in reversed(list(zip(docs.columns, safe, strict=True)))}
    exact = dict(zip(docs.columns, safe, strict=True))
    found = work(docs.toDF(*safe), *[exact.get(n) or place[n.lower()] for n in names])
    return found.toDF(*docs.columns, *added)


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def first_by_hash(df: DataFrame, order: str, rows: int, count: int) -> DataFrame:
    """The first ``rows`` rows by the hash in ``order``, of ``count`` in all.

    Rows that can hardly be among them are left out first, so that every task sends
    few; each still counts where the table is small.
    """
    space = 1 << 40
    share = min(1.0, (2.0 * rows + 50) / max(1, count))
    near = df if share == 1.0 else df.where(F.pmod(F.col(order), F.lit(space)) < int(share * space))
    by_hash = [F.pmod(F.col(order), F.lit(space)), *[c for c in df.columns if c != order]]
    return near.orderBy(*by_hash).limit(rows)


def chunks(texts: Iterable[str | None]) -> Iterator[list[bytes]]:
    """UTF-8 texts in runs of about ``CHUNK_BYTES``; null becomes empty."""
    part, size = [], 0
    for text in texts:
        part.append(text.encode("utf-8", "surrogatepass") if text else b"")
        size += len(part[-1])
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


#: Rows of an Arrow batch, where the session doesn't say: texts are long, and a
#: task holds a batch several times.
BATCH_ROWS = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the session fit for Python tasks: small Arrow batches, and this package.

    The package goes to the executors once an application, as Spark ships Python
    files; the driver serves the archive, so it may lie in a folder of its own.
    """
    context = spark.sparkContext
    if context.getConf().get(BATCH_SETTING) is None:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
