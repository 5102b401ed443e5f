"""The registered queries of the operators that SQL can express, on whole tables and on rows of every odd kind."""

import os

import duckdb
import pytest

from parallax.llm import queries

DIR = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()


def _equal(spark, name, folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"create view {f[:-8]} as select * from '{folder}/{f}{'' if os.path.isfile(f'{folder}/{f}') else '/*.parquet'}'")
    df = queries.queries()[name](spark, folder)
    names = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in names)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=str)
    assert got == sorted(con.execute(f"select {quoted} from ({SQL[name]})").fetchall(), key=str)
    return len(got)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert _equal(spark, name, DIR)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    long = " ".join(f"w{i * i % 977}" for i in range(30_000))
    words = [f"v{i * 7919 % 1009}" for i in range(120)]
    texts = [None, "", " \n\t ", "one two", "one two", "ÄÖ ß 日本 " * 30, long, long[5_000:90_000], " ".join(words), " ".join(words[:118]), " ".join(words[:60] + ["x"] + words[61:])]
    texts += ["same line here\n" * 20, "A b C d e\x0bf", "a B c D e f", "#$%& <tag> |" * 20]
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "web"][i % 2], "extra", None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, words string, kept string").write.parquet(f"{folder}/documents.parquet")
    x = [float(i % 5) - 2 for i in range(16)]
    near = [v + 0.1 * (i % 2) for i, v in enumerate(x)]
    vectors = [None, [], [0.0] * 16, x, x, near, [2 * v for v in x], [-v for v in x], x[:8], [*x[:15], None], [*x[:15], float("nan")], [*x[:15], float("inf")]]
    spark.createDataFrame([(i, v, 1, 9) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int, key int").write.parquet(f"{folder}/embeddings.parquet")
    turns = [(c, t, r, x, "extra") for c in (None, 1, 2) for t, r, x in [(None, None, None), (0, "system", "Be brief."), (1, "user", "Why?"), (1, "user", "Why?"), (2, "Assistant", "Because"), (5, "assistant", "\u00a0"), (5, "", "x."), (6, "user", "Über.\x0b"), (7, "tool", long)]]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, audit string").write.parquet(f"{folder}/conversations.parquet")
    items = [(1, "v1 w0 Größe ß w0"), (2, None), (3, " "), (None, "one two"), (5, "日本 w1"), (5, "w4 W4"), (5, "w4 W4"), (7, long[:9_000])]
    spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, score int").write.parquet(f"{folder}/benchmark.parquet")
    return folder


ROWS = {"op5_vectors": 12, "op12_turns": 3}


@pytest.mark.parametrize("name", sorted(SQL))
def test_odd_rows(spark, odd, name):
    n = _equal(spark, name, odd)
    assert n == ROWS.get(name, 15) or name == "op11_search"


@pytest.mark.parametrize("name", sorted(SQL))
def test_empty_tables(spark, tmp_path, name):
    for table, schema in (("documents", "doc_id long, text string, lang string, source string"), ("embeddings", "vec_id long, embedding array<float>"), ("conversations", "conv_id long, turn long, role string, text string"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    assert _equal(spark, name, str(tmp_path)) == 0
