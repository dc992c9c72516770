import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from bench import local_session
    s = local_session("*", shuffle_partitions=8, app="ratelens-tests")
    yield s
    s.stop()


@pytest.fixture
def write_files(tmp_path):
    """Write {name: text} into a fresh folder; returns name -> path."""
    def _write(files: dict[str, str], sub: str = "in"):
        d = tmp_path / sub
        d.mkdir(exist_ok=True)
        out = {}
        for name, text in files.items():
            p = d / name
            p.write_text(text, encoding="utf-8")
            out[name] = str(p)
        return out
    return _write


# Invented rows in the layouts of the rating inputs (see FIXTURES.md).
RATINGS_1 = "1, 10, 3.5, 1577836800\n2,11,x,5\nbad\n\n"
RATINGS_2 = ("UserID,MovieID,Rating,Timestamp\n4,10,5.0,1577836799\n9,10,4.0,1600000000\n"
             "1,99,2.0,1600000000\n")
MOVIES = "10, First Film (1990), Drama|Crime\n11, Second Film (1991), Drama\n"
USERS = "1,M,17,1\n2,F,18,2\n4,F,51,7\n"
OCCUPATIONS = "1,Programmer\n2,Doctor\n"


@pytest.fixture
def star_files(write_files):
    return write_files({"ratings_1.txt": RATINGS_1, "ratings_2.txt": RATINGS_2, "movies.txt": MOVIES,
                        "users.txt": USERS, "occupation.txt": OCCUPATIONS})


@pytest.fixture
def star(spark, star_files):
    from ratelens.plans.ratings import RatingsStar
    from ratelens.sources import files as S
    f = star_files
    return RatingsStar(
        ratings=S.read_ratings(spark, [f["ratings_1.txt"], f["ratings_2.txt"]]),
        movies=S.read_movies(spark, f["movies.txt"]),
        users=S.read_users(spark, f["users.txt"]),
        occupations=S.read_occupations(spark, f["occupation.txt"]),
    )


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
