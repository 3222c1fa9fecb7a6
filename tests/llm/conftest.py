import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


import pytest
from edge_cases import BENCHMARK, CONVERSATIONS, DOCUMENTS, EDGE, LABELS, PAGES
from pyspark.sql import functions as F

def tables(spark, path, edge: bool, extra: bool = True):
    """A folder with the tables; extra columns have names that the
    operators use inside."""
    def put(name, rows, schema):
        df = spark.createDataFrame(rows if edge else [], schema)
        if extra:
            for c in ("rid", "h", "n", "_row", "size", "pattern", "text_hash", "host", "score", "item", "words", "cid", "times", "digest", "key", "m", "places", "form", "output", "gone", "lead", "h1", "fault", "audit", "seq"):
                df = df.withColumn(c, F.lit("clash"))
        df.write.parquet(f"{path}/{name}.parquet")
    put("documents", EDGE, DOCUMENTS)
    put("labels", LABELS, "doc_id long, quality int, toxic int")
    put("benchmark", BENCHMARK, "item_id long, text string")
    put("conversations", CONVERSATIONS, "conv_id long, turn long, role string, text string")
    put("pages", PAGES, "page_id long, url string, html string")
    return str(path)


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("edge"), True)


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("empty"), False)


@pytest.fixture(scope="session")
def small_docs(spark, sf_dir):
    return [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a query as plain tuples of some columns, in order."""
    def of(df, *columns):
        got = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
        return sorted(got, key=lambda r: tuple((x is not None, x) for x in r))
    return of


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
