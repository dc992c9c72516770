import random
import re

import pytest

from ratelens.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def brute(rows, width, percent):
    """component_id per row position, from all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j > i}:
            if rows[i][0] is not None and rows[j][0] is not None \
                    and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                root[find(j)] = find(i)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = k if low.get(find(i)) is None else min(low[find(i)], k if k is not None else low[find(i)])
    return sorted(((k, len(sets[i]), low[find(i)]) for i, (k, _) in enumerate(rows)), key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in ngram_join.link_components(df, **kw).collect()), key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "w%d" % rng.randrange(10**6)
    return " ".join(words)


def made_rows(seed):
    rng = random.Random(seed)
    rows, k = [], 0
    common = [f"c{i}" for i in range(60)]
    for _ in range(25):  # groups of near copies, drifting along a chain, sharing one passage
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([5, 11, 12, 40, 300]))] + common * rng.randrange(2)
        for _ in range(rng.randrange(1, 12)):
            text = edited(rng, words, rng.randrange(0, 3))
            words = text.split() if rng.random() < 0.5 else words
            rows.append((k, text.upper() if rng.random() < 0.2 else text))
            k += 1
    return rows + [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "ONE  two"), (905, "one"),
                   (None, "one two"), (None, None), (906, "a b c d e f g h i j k"), (907, "a b c d e f g h i j k l")]


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_equals_all_pairs(spark, width, percent):
    rows = made_rows(width)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df, width=width, percent=percent) == brute(rows, width, percent)


def test_equals_all_pairs_on_the_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert run(df) == brute(rows, 3, 90)


def test_large_group_and_repeats(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, edited(rng, words, 1)) for i in range(400)] + [(5000, "x y z"), (5000, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert run(df) == brute(rows, 3, 90)


def test_empty_table_and_further_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert run(empty) == []
    df = spark.createDataFrame([(1, "a b c d", 9, 8, 7)], "doc_id long, text string, n int, node int, component long")
    assert run(df) == [(1, 2, 1)]


def test_repeated_ids_are_placed_by_their_own_texts(spark):
    rng = random.Random(9)
    a, b, c = ([f"{x}{i}" for i in range(100)] for x in "abc")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, edited(rng, a, 1)), (3, edited(rng, b, 1)), (4, " ".join(c)),
            (0, edited(rng, c, 1)), (4, "alone in this text"), (5, edited(rng, c, 1)), (5, edited(rng, a, 1)), (6, " ".join(a) + " z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert run(df) == brute(rows, 3, 90)
    kept = sorted((r.doc_id, r.text) for r in ngram_join.drop_near_copies(df).collect())
    assert kept == sorted([rows[0], rows[1], rows[5], rows[6]])


def test_one_text_of_an_id_stays_in_a_component(spark):
    rng = random.Random(10)
    a = [f"a{i}" for i in range(100)]
    rows = [(1, " ".join(a)), (1, edited(rng, a, 1)), (1, edited(rng, a, 2)), (2, edited(rng, a, 1)), (3, "apart from all"), (3, ""), (3, None)]
    kept = [r.text for r in ngram_join.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len([t for t in kept if t and len(t) > 20]) == 1 and sorted(t or "-" for t in kept if not t or len(t) < 20) == ["-", "-", "apart from all"]


def test_drop_near_copies_keeps_the_smallest(spark):
    base = " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(3, base, "s"), (2, base + " more", "s"), (9, "other words here", "s"), (None, base, "s")],
                               "doc_id long, text string, source string")
    kept = ngram_join.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 9, None]


def test_many_rows_that_repeat_two_near_texts(spark):
    rng = random.Random(11)
    a = [f"a{i}" for i in range(100)]
    near = edited(rng, a, 1)
    rows = [(1, " ".join(a))] * 400 + [(2, near)] * 400 + [(3, "apart from all others")]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == sorted(
        [(1, 98, 1)] * 400 + [(2, len(shingles(near, 3)), 1)] * 400 + [(3, 2, 3)], key=str)


def test_query_equals_its_sql(spark):
    import duckdb

    from ratelens.llm import queries
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    got = sorted(tuple(r) for r in queries.op7_ngram_join(spark, sf).collect())
    assert got == sorted(con.execute(queries.ORACLE["op7_ngram_join"]).fetchall())
