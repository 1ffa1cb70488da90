"""Tables written once and read again, in the folder that all executors share."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from noticelake.session import shared_dir


def stored(df: DataFrame, ascending: bool = False) -> DataFrame:
    """df as a compressed table in the shared folder; what is read from it does not depend on executors' disks.

    ascending: numbers mostly grow from row to row, so their differences are written.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{os.urandom(8).hex()}"
    write = df.write.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false") if ascending else df.write
    write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables that an operator needs no longer once its own result is stored."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def stored(self, df: DataFrame, ascending: bool = False) -> DataFrame:
        self.tables.append(stored(df, ascending))
        return self.tables[-1]

    def drop(self, *tables: DataFrame) -> None:
        """Delete these tables, or all."""
        for table in tables or list(self.tables):
            self.tables = [t for t in self.tables if t is not table]
            context = table.sparkSession.sparkContext
            for folder in {os.path.dirname(f) for f in table.inputFiles()}:
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def fresh(columns: list[str], *names: str) -> list[str]:
    """These names, each with as many _ before it as it takes to be none of the columns."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
