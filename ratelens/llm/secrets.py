"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every file (here: every row's text) is content-addressed by
SHA-256. The ledger holds one row per (blob, rule, rule version) that has been
scanned. ``scan`` scans only blobs that lack a pair, once per distinct blob
however many paths hold it, and joins the findings of old and new pairs back
to all paths; those of a blob that very many paths hold are dealt to several
tasks. A ledger is a Parquet table in a shared folder that each scan creates or
appends to. It is read by key: a pair that a repeated or simultaneous run has
written twice counts once, as its spans depend on the blob and the version alone.

Spans come from two passes of one pattern: ``regexp_extract_all`` gives the
matches and ``split`` the gaps between them, both leftmost non-overlapping;
starts are running sums of their lengths in code points.

Rules of kind assign, access and hex are the base rules; pem, jwt and hook
are added ones. ``[0-9a-f]{16,}`` finds the runs of ``[0-9a-f]+`` of 16 or
more characters, and ``AKIA[A-Z0-9]{14,}`` those of ``AKIA[A-Z0-9]+`` of 18 or
more: a failing match ends where its run ends, so none hides a passing one.
The assign rule keeps its open pattern, as a failing match there may hide a
later one; its matches are dropped by length afterwards.

Defined cases: null text is the empty blob, without spans. Equal texts share
one blob, repeated rows and ids all get its findings; a null id is returned as
null. Spans of different kinds may overlap; ties on start go by kind as
listed. Long texts are scanned whole, and masked by pieces, in time linear in
their length and spans. An empty table gives an empty result. ``scan`` reads
only the id and text columns; ``redact_documents`` renames the caller's columns while
it works, so further columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ratelens.llm.common import Scratch, exists, salted_join, shared_dir

RUN = 256  # spans gathered before they are put away
SPAN = "struct<start:int,rank:int,kind:string,end:int>"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    version: int = 1
    base: bool = True
    value_group: int = 0      # group whose length is tested
    min_value: int = 0


# The base patterns of the contract, then the added ones.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         value_group=2, min_value=12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", base=False),
    Rule("hook", r"(?:ghp|gho|xoxb|xoxp|sk_live)[_-][A-Za-z0-9_-]{16,}", base=False),
)

LEDGER_SCHEMA = f"blob binary, kind string, version int, spans array<{SPAN}>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """All spans of one rule in a text, ascending."""
    matched = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    lens = F.transform(matched, F.length)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    values = (F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.value_group)), F.length)
              if rule.min_value else lens)
    none = F.array().cast(f"array<{SPAN}>")
    zero = F.struct(F.lit(0).alias("at"), none.alias("last"), F.array().cast(f"array<array<{SPAN}>>").alias("full"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["len"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
                        end.alias("end")).cast(SPAN)
        last = F.when(x["val"] >= rule.min_value, F.concat(acc["last"], F.array(span))).otherwise(acc["last"])
        return F.struct(end.alias("at"), last.alias("last"), acc["full"].alias("full"))

    def close(acc: Column) -> Column:  # a full run is put away, so that appending never copies a long array
        put = F.size(acc["last"]) >= RUN
        return F.struct(acc["at"].alias("at"), F.when(put, none).otherwise(acc["last"]).alias("last"),
                        F.when(put, F.concat(acc["full"], F.array(acc["last"]))).otherwise(acc["full"]).alias("full"))

    parts = F.arrays_zip(lens.alias("len"), F.slice(gaps, F.lit(1), F.size(lens)).alias("gap"), values.alias("val"))
    found = F.aggregate(parts, zero, lambda acc, x: close(step(acc, x)),
                        lambda acc: F.concat(F.flatten(acc["full"]), acc["last"]))
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _addressed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (df.select(F.col(id_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("blob", F.unhex(F.sha2("text", 256))))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_new(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ledger rows for the (blob, rule version) pairs not yet in ``ledger``:
    one per pair, with its spans (none for a clean blob)."""
    blobs = _addressed(versions, id_col, text_col).select("blob", "text")
    if ledger is None:
        missing = blobs.distinct().withColumn("todo", F.array(*[F.lit(r.kind) for r in rules]))
    else:
        known = F.array_agg(F.struct("kind", "version"))
        have = ledger.groupBy("blob").agg(known.alias("have"))
        todo = F.filter(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
                                  for r in rules]),
                        lambda r: F.col("have").isNull() | ~F.array_contains(F.col("have"), r))
        # one text a blob, dealt by blob as the join needs it: texts move once
        one = blobs.groupBy("blob").agg(F.first("text").alias("text"))
        missing = (one.join(have, "blob", "left").withColumn("todo", F.transform(todo, lambda r: r["kind"]))
                   .where(F.size("todo") > 0))
    found = [F.when(F.array_contains("todo", r.kind),
                    F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                             _spans(F.col("text"), r, i).alias("spans")))
             for i, r in enumerate(rules)]
    return (missing.select("blob", F.explode(F.array_compact(F.array(*found))).alias("f"))
            .select("blob", "f.kind", "f.version", "f.spans"))


def blob_findings(ledger_rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per blob with any span of the current rule versions: all its spans, by
    start, then kind as listed (at most one ledger row per rule meets here)."""
    current = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    rows = ledger_rows.where((F.size("spans") > 0) & (F.col("version") == F.element_at(current, F.col("kind"))))
    pairs = rows.repartition("blob").groupBy("blob", "kind", "version").agg(F.first("spans").alias("spans"))
    return pairs.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def findings(versions: DataFrame, ledger_rows: DataFrame, rules: tuple[Rule, ...] = RULES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``versions``: doc_id, blob and all spans of the blob."""
    rows = Scratch(versions.sparkSession).written(_addressed(versions, id_col, text_col).select("path", "blob"), "blob-paths")
    return (salted_join(rows, blob_findings(ledger_rows, rules), ["blob"], ["path"], "left")
            .select(F.col("path").alias("doc_id"), "blob",
                    F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")))


def update_ledger(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scan the pairs that the ledger at ``ledger_path`` lacks, append them
    (creating it if there is none) and return the whole ledger."""
    spark = versions.sparkSession
    seen = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path) if exists(spark, ledger_path) else None
    scan_new(versions, seen, rules, id_col, text_col).write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def shared_ledger(spark: SparkSession) -> str:
    """The ledger of all runs that share the session's folder."""
    return f"{shared_dir(spark).rstrip('/')}/secret-ledger"


def scan(versions: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The findings of every row, scanning only what the ledger at
    ``ledger_path`` lacks. Without a path nothing is remembered."""
    ledger = (scan_new(versions, None, rules, id_col, text_col) if ledger_path is None
              else update_ledger(versions, ledger_path, rules, id_col, text_col))
    return findings(versions, ledger, rules, id_col, text_col)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_columns(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The counts and digests of the findings of each row."""
    base = [r.kind for r in rules if r.base]
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in base]
    return found.select("doc_id", *counts,
                        F.sha2(_joined(F.filter(spans, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
                        _joined(spans).alias("spans"))


MASK = "[SECRET]"
PIECE = 4096  # code points of a text that are cut at once


def merged(found: DataFrame) -> DataFrame:
    """Per blob: its spans (``found``: blob, spans) with overlapping ones as one, ascending."""
    s = found.select("blob", F.explode("spans").alias("s")).select("blob", F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                                                                   F.col("s.rank").alias("rank"))
    order = Window.partitionBy("blob").orderBy("start", "rank")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    s = s.select("blob", "start", "end", F.when(F.col("start") < reach, 0).otherwise(1).alias("new"), "rank")
    s = s.select("blob", "start", "end", F.sum("new").over(order).alias("run"))
    runs = s.groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))


def redacted(text: Column, cuts: Column) -> Column:
    """``text`` with every span of ``cuts`` (ascending, apart) masked: what lies
    between them is taken from pieces of the text, so no long text is walked from its start again."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def between(pieces: Column, a: Column, b: Column) -> Column:
        first, last = F.floor(a / PIECE).cast("int"), F.floor((b - 1) / PIECE).cast("int")
        part = F.transform(F.sequence(first, last), lambda j: F.substring(
            F.get(pieces, j), F.greatest(a - j * PIECE, F.lit(0)) + 1, F.least(b - j * PIECE, F.lit(PIECE)) - F.greatest(a - j * PIECE, F.lit(0))))
        return F.when(a < b, F.array_join(part, "")).otherwise("")
    starts = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda s: s["end"]))
    ends = F.concat(F.transform(cuts, lambda s: s["start"]), F.array(F.length(text)))
    # bound as a lambda variable: the text is cut into pieces once, not once per span
    bound = F.transform(F.array(pieces), lambda p: F.array_join(F.zip_with(starts, ends, lambda a, b: between(p, a, b)), MASK))
    return F.get(bound, F.lit(0))


def redact_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger_path: str | None = None) -> DataFrame:
    """All rows of ``docs`` (columns unchanged) with secrets masked in
    ``text`` and ``n_chars`` counted anew where a text changed."""
    ledger = scan_new(docs, None, rules) if ledger_path is None else update_ledger(docs, ledger_path, rules)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of the caller cannot clash
    text = F.col(f"c{docs.columns.index('text')}")
    rows = plain.withColumn("blob", F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)))
    out = salted_join(rows, merged(blob_findings(ledger, rules)), ["blob"], [f"c{i}" for i, t in enumerate(docs.dtypes) if "map<" not in t[1]], "left")
    # a name of its own: inside a lambda, the text would mean the new column
    out = out.withColumn("masked", F.when(F.col("cuts").isNull(), text).otherwise(redacted(text, F.col("cuts"))))
    cols = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        held = F.col(f"c{docs.columns.index('n_chars')}")
        cols["n_chars"] = F.when(F.col("cuts").isNull(), held).otherwise(F.length("masked").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*[cols.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])
