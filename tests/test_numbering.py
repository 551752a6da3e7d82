"""Places in order without a single task, and tables in the shared folder."""

import pathlib
import random

import pytest

from taxaloom import session
from taxaloom.operators.numbering import numbered


def test_places_totals_and_groups(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, "a", "b", "", "é"]) if i % 2 else "hot", rng.choice([None, *range(40)]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, x int, id long").repartition(7)
    got = numbered(df, ["g"], ["x", "id"], "pos", "n", "group").collect()
    order = lambda r: (r[1] is not None, r[1] or 0, r[2])
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(r)
    place = {r[2]: (k, len(own)) for own in want.values() for k, r in enumerate(sorted(own, key=order))}
    assert {r["id"]: (r["pos"], r["n"]) for r in got} == place
    number = {r["g"]: r["group"] for r in got}
    assert len(set(number.values())) == len(number) == len({(r["g"], r["group"]) for r in got})
    assert sorted(number, key=number.get) == sorted(number, key=lambda s: (s is not None, (s or "").encode()))
    assert sorted(r["pos"] for r in numbered(df, [], ["id"]).collect()) == list(range(600))
    assert numbered(df.where("false"), ["g"], ["x"]).collect() == []


def test_superseded_tables_go(spark):
    one = session.cut(spark.range(3))
    two = session.cut(one.selectExpr("id + 1 AS id"), one)
    assert sorted(r[0] for r in two.collect()) == [1, 2, 3]
    assert not pathlib.Path(one.cut_path.removeprefix("file:")).exists() and pathlib.Path(two.cut_path.removeprefix("file:")).exists()


def test_clusters_need_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.shared_folder(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs://x/y/"
    assert session.shared_folder(Session) == "hdfs://x/y/taxaloom"
