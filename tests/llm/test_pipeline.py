"""The pipeline's stages on small tables, against plain Python."""

import random
from collections import Counter

import pytest

import corpus_pipeline as cp
from tessera.llm import sigtree

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns that clash with names used inside.
EXTRA = ["__at", "__id", "__starts", "at", "key", "row", "copy", "starts", "lines_removed", "position", "size", "part", "kept", "d2", "component_id"]


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def table(spark, rows):
    df = spark.createDataFrame([(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows], COLUMNS)
    from pyspark.sql import functions as F

    return df.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in EXTRA])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [(k, prose(rng, rng.randrange(60, 160)), "en" if k % 3 else None, "hot" if k % 3 else f"s{k % 2}") for k in range(30)]
    passage = f"{prose(rng, 20)}\n{prose(rng, 20)}"
    out += [(30 + k, f"{prose(rng, 60)}\n{passage}", "en", "hot") for k in range(3)]
    near = out[4][1].split()
    out += [(33, " ".join([*near[:-1], "other"]), "en", "hot"), (34, out[4][1], "en", "hot")]
    out += [(7, out[7][1], out[7][2], out[7][3])] * 2  # row 7 three times
    out += [(8, prose(rng, 90), "en", "hot"), (8, "too short", "en", "hot")]  # other rows of id 8
    out += [(40, None, "en", "hot"), (41, "", None, None), (42, " \n\t", "en", "hot"), (None, prose(rng, 70), "en", None), (43, f"{passage}\n", "en", "hot")]
    out += [(44, prose(rng, 30_000), "en", "long")]
    return out


def seen(df):
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def test_stages_keep_columns_and_whole_rows(spark, rows, tmp_path):
    docs = table(spark, rows)
    before = seen(docs)
    for name, step in cp.STAGES[:-1]:
        out = step(spark, docs, "")
        assert out.columns == docs.columns, name
        assert all(r["__at"] == (None if r.doc_id is None else f"__at{r.doc_id}") for r in out.collect()), name
        if name != "line dedup":
            assert set(seen(out)) <= set(before), name
    docs.write.parquet(str(tmp_path / "docs"))
    packed = cp.ordered_packing(spark, spark.read.parquet(str(tmp_path / "docs")), "").collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(i for i, *_ in rows)


def test_quality_judges_every_row(spark, rows):
    got = seen(cp.quality_rules(spark, table(spark, rows), ""))
    assert got == Counter(r for r in rows if r[1] is not None and len(r[1].split()) >= 50)


def test_lines_of_repeated_rows(spark, rows):
    got = seen(cp.line_dedup(spark, table(spark, rows), ""))
    assert got[rows[7]] == 3 and got[rows[30]] == 1
    body = lambda k: rows[k][1].split("\n")[0]
    assert got[31, body(31), "en", "hot"] == got[32, body(32), "en", "hot"] == 1
    assert not any(i == 43 for i, *_ in got)  # nothing but the passage
    assert (40, None, "en", "hot") in got


def test_one_of_each_group_stays(spark, rows):
    got = seen(cp.jaccard_join(spark, table(spark, rows), ""))
    assert got[rows[4]] == 1 and not any(i in (33, 34) for i, *_ in got)
    assert got[rows[7]] == 3 and (None, *rows[-3][1:]) in got


def test_mix_takes_rows_not_ids(spark, rows):
    docs = table(spark, [r for r in rows if r[1] and r[1].strip()])
    before, got = seen(docs), seen(cp.curriculum_mix(spark, docs, ""))
    assert set(got) <= set(before) and all(n <= 2 * before[r] for r, n in got.items())
    one = table(spark, [(7, "a b c", "en", "hot")] * 3)
    assert seen(cp.curriculum_mix(spark, one, "")) in (Counter({(7, "a b c", "en", "hot"): n}) for n in (5, 6))
    two = table(spark, [(7, "a b c", "en", "hot"), (7, "d e f", "en", "hot")])
    assert max(seen(cp.curriculum_mix(spark, two, "")).values()) <= 2


def test_empty_and_wordless_tables(spark, rows):
    for chosen in ([], [(1, None, None, None), (None, "", "en", "hot"), (1, None, None, None)]):
        docs = table(spark, chosen)
        for name, step in cp.STAGES[:-1]:
            assert step(spark, docs, "").columns == docs.columns, name


def test_run_is_its_stages(spark, rows, tmp_path):
    table(spark, rows).select(*[c.split()[0] for c in COLUMNS.split(", ")]).write.parquet(str(tmp_path / "documents.parquet"))
    got = cp.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, step in cp.STAGES[:3]:
        docs = step(spark, docs, "")
    left = seen(docs)
    assert {r.doc_id for r in got} == {i for i, *_ in left}
    # whole documents, once or twice each
    tokens = Counter()
    for r in got:
        tokens[r.doc_id, r.doc_tokens] += r.length
    for (i, n), total in tokens.items():
        assert total % n == 0 and total // n <= 2 * sum(c for r, c in left.items() if r[0] == i)
    groups = sigtree.jaccard_groups(docs, 5, 80).collect()
    assert all(r.component_id == r.doc_id for r in groups)
