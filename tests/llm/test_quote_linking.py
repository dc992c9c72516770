import random
import re
import time

import duckdb

from ratelens.llm import queries, quote_linking as Q

M = [
    (1, 0, "user", "First question here\nSecond line"),
    (1, 1, "assistant", "> First question here\nAn answer"),
    (1, 2, "user", "> > First  question HERE\n> An answer\nThanks"),
    (1, 3, "user", ">Second line\nAbout that"),
    (1, 4, "assistant", ">> An answer\n> nobody said this\nOnly the inner quote is known"),
    (1, 5, "user", "An answer\n> An answer\n\n"),
    (1, 6, None, "> About that\n> An answer\n> Thanks\nties go to the later"),
    (2, 0, "user", "> First question here\nother conversation"),
    (2, 1, "user", None), (2, 1, "user", None), (2, 3, "user", "> \n>\n"),
    (None, 4, "user", "> First question here"), (3, None, "user", "x"),
    (4, 0, "user", "A long paragraph that\nwraps here\n\nanother one"), (4, 1, "user", "another one"),
    (4, 2, "user", "> A long\n> paragraph   that wraps HERE\nwrapped anew"),
    (4, 3, "user", "> A long paragraph that\n> wraps here\n>\n> another one\nwhole"),
]


def place(rows):
    return {(r.conv_id, r.turn): (r.parent_turn, r.thread_root, r.depth, r.n_linked) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def sql(rows):
    con = duckdb.connect()
    con.execute("create table messages(conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into messages values (?, ?, ?, ?)", rows)
    return con.execute("with recursive " + queries.OP9_OVER).fetchall()


def test_links_and_order(spark):
    got = Q.format_chats(frame(spark, M)).collect()
    assert len(got) == len(M)
    at = place(got)
    assert at[1, 1] == (0, 0, 1, 1)
    assert at[1, 2] == (1, 0, 2, 1)         # the outer level decides
    assert at[1, 3] == (0, 0, 1, 1)
    assert at[1, 4] == (1, 0, 2, 1)         # the outer quote is unknown, the inner one links
    assert at[1, 5] == (1, 0, 2, 1)
    assert at[1, 6] == (3, 0, 2, 1)         # one line each of three messages: the latest
    assert at[4, 2] == (0, 0, 1, 1)         # the passage is known, its lines are not
    assert at[4, 3] == (0, 0, 1, 4)         # three lines and a passage
    assert at[2, 0] == (None, 0, 0, 0) and at[2, 3] == (None, 3, 0, 0)
    assert at[None, 4] == (None, 4, 0, 0) and at[3, None] == (None, None, 0, 0)
    text = {(r.conv_id, r.turn): (r.text, r.chat) for r in got}
    assert text[1, 2] == ("Thanks", "<|user|>\nThanks\n")
    assert text[1, 6][1].startswith("<|user|>\n") and text[2, 1] == ("", "<|user|>\n\n")
    order = [r.turn for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: (r.thread_root, r.position))]
    assert order == [0, 1, 2, 4, 5, 3, 6]  # each reply behind its parent, with the replies to it
    whole = {(r.conv_id, r.thread_root, r.part): r.chat for r in Q.transcripts(Q.format_chats(frame(spark, M)), 4).collect()}
    at = {r.turn: r.chat for r in got if r.conv_id == 1}
    assert whole[1, 0, 0] == at[0] + at[1] + at[2] + at[4] and whole[1, 0, 1] == at[5] + at[3] + at[6]


def test_equals_sql(spark):
    got = sorted((tuple(r) for r in Q.format_chats(frame(spark, M)).collect()), key=str)
    assert got == sorted(sql(M), key=str)


def test_long_chain_and_hot_message(spark):
    chain = [(1, 0, "user", "line 0")] + [(1, i, "user", f"> line {i - 1}\nline {i}") for i in range(1, 70)]
    hot = [(2, 0, "user", "root")] + [(2, i, "user", "> root\nsame words") for i in range(1, 500)]
    got = place(Q.format_chats(frame(spark, chain + hot).repartition(7)).collect())
    assert all(got[1, i] == (i - 1, 0, i, 1) for i in range(1, 70))
    assert all(got[2, i] == (0, 0, 1, 1) for i in range(1, 500))


def test_random_trees_equal_sql(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(6):
        said = []
        for turn in range(40):
            quoted = rng.choice(said) if said and rng.random() < .8 else None
            said.append(f"line {conv} {turn}")
            rows.append((conv, turn, "user", (f"> {quoted}\n" if quoted else "") + said[-1]))
    got = sorted((tuple(r) for r in Q.format_chats(frame(spark, rows)).collect()), key=str)
    assert got == sorted(sql(rows), key=str)


def test_a_message_of_many_lines(spark):
    lines = [f"{'> ' * (i % 7 // 5)}line {i % 50_000}" if i % 11 else "" for i in range(200_000)]
    df = frame(spark, [(1, 0, "user", "\n".join(f"line {i}" for i in range(1000))), (1, 1, "user", "\n".join(lines))])
    begin = time.time()
    got = place(Q.format_chats(df).collect())
    assert got[1, 1][0] == 0 and time.time() - begin < 60


def test_query_links_and_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    got = sorted((tuple(r) for r in queries.op9_quotation_linking(spark, sf).collect()), key=str)
    assert got == sorted(con.execute(queries.ORACLE["op9_quotation_linking"]).fetchall(), key=str)
    assert sum(r[7] > 0 for r in got) > len(got) / 3


def test_native_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", 5, 6)], "conv_id long, turn long, role string, text string, depth int, hash int")
    out = Q.format_chats(df)
    assert [tuple(r) for r in out.collect()] == [(1, 0, "user", None, 0, 0, 0, 0, "a", "<|user|>\na\n")]
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())
    assert Q.format_chats(df.where("false")).collect() == []
