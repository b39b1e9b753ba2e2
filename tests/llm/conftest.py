import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, size string, score string, tag string, shard string, id string, key string")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) tuples, with extra columns whose names clash with inner ones."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) + ("x",) * 7 for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.repartition(partitions) if full else df
    return make


@pytest.fixture(scope="session")
def small_texts():
    """The first texts of the smallest driver table."""
    import duckdb
    return duckdb.sql("select doc_id, text, source from '/root/testdata/sf0.001/documents.parquet' order by doc_id").fetchall()


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "null id here"), (5, "a b c d"),
        (6, "wörter über alles 'quoted' 123"), (7, "x" * 5000), (8, " \x1c odd spaces")]


@pytest.fixture(scope="session")
def edge_rows():
    return list(EDGE)
