from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from ratelens import sinks
from ratelens.sources import files as S


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", None), (2, "c", "x")], "id int, review string, aspect string")
    sinks.write_tsv(df, str(tmp_path / "out"))
    back = S.read_reviews_tsv(spark, str(tmp_path / "out"))
    assert sorted(rows(back, "id", "review", "aspect")) == [("1", "a b", None), ("2", "c", "x")]


def test_tsv_writes_values_byte_for_byte(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb", " lead ", '"q"', None, "")], "n int, a string, b string, c string, d string, e string")
    sinks.write_tsv(df, str(tmp_path / "out"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert data == b'1\ta\tb\t lead \t"q"\t\t\n' and b"\x00" not in data


def test_tsv_of_the_age_report(spark, star, tmp_path):
    from ratelens.functions.render import age_sentence
    from ratelens.plans import ratings as R
    wide = R.age_wide_text(star, "four")
    labels = R.PRESETS["four"].labels
    sinks.write_tsv(age_sentence(wide, labels, [R.age_column(x) for x in labels]), str(tmp_path / "age"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "age")).collect()]
    assert "First Film (1990)\t0-18: 3.50\t18-35: NA\t35-50: NA\t50+: 5.00\t" in lines


def test_staged_data_is_deleted(spark):
    staged = sinks.stage(spark.range(10).toDF("id"), "gone")
    assert staged.count() == 10
    folder = staged.inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[-1]
    sinks.unstage(staged)
    import os
    assert not os.path.exists("/" + folder.lstrip("/"))


def test_stage_cuts_lineage_in_checkpoint_dir(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as v")
    staged = sinks.stage(df, "t")
    ckpt = spark.sparkContext.getCheckpointDir()
    def bare(uri):
        return "/" + uri.split(":", 1)[-1].lstrip("/")
    assert ckpt and bare(staged.inputFiles()[0]).startswith(bare(ckpt).rstrip("/") + "/")
    assert staged.count() == 100


def test_review_jobs_write_all_outputs(spark, tmp_path):
    from ratelens.plans.jobs import run_review_jobs
    from ratelens.sources.tables import review_lines
    out = run_review_jobs(review_lines(spark, SF_SMALL), str(tmp_path / "reviews"))
    assert len(out) == 9
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("freq", T.LongType())])
    top = S.read_delimited(spark, out["top_words_k"], schema, sep="\t")
    assert top.count() == 5


def test_fixed_width_rendering(spark):
    from ratelens.functions.render import MOVIE_ROW, fixed_width
    df = spark.createDataFrame([(1015, "Sunset Boulevard (1950)", 4.3571, 7)],
                               "movie_id int, title string, avg_rating double, n long")
    line = fixed_width(df, MOVIE_ROW).first()[0]
    assert line == f"{'1015':<7} | {'Sunset Boulevard (1950)':<60} | {'4.36':<10} | {'7':<12}"


def test_library_requires_shared_checkpoint_dir(spark):
    from ratelens.session import checkpoint_dir
    assert checkpoint_dir(spark)  # tests run with a folder set by local_session


def test_escaped_tsv_reads_back_every_value(spark, tmp_path):
    values = ["a\tb", "two\nlines", "cr\rlf\r\n", "back\\slash", "\\t", "\\\\n\\", "\\N", "", None, " edge ", "é\u2028x", "\t", "\\\t\\"]
    df = spark.createDataFrame([(str(i), v, values[-1 - i], None, "") for i, v in enumerate(values)], S.schemas.REVIEWS_TEXT)
    sinks.write_tsv(df, str(tmp_path / "out"), escaped=True)
    assert spark.read.text(str(tmp_path / "out")).count() == len(values)
    back = S.read_reviews_tsv(spark, str(tmp_path / "out"), escaped=True)
    assert sorted(rows(back), key=str) == sorted(rows(df), key=str)
