import pytest

from reelrank.sources import loaders


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_movie_line_with_empty_trailing_fields(spark):
    df = loaders.parse_movie_lines(lines(spark, " 7 ^ Heat \t^^^^^^Action|Crime^^"))
    r = df.first()
    assert r.mid == 7 and r.name == "Heat" and r.genres == "Action|Crime"
    assert r.actors == "" and r.directors == "" and r.descri == ""
    assert df.columns == ["mid", "name", "descri", "timelong", "issue", "shoot", "language",
                          "genres", "actors", "directors"]


def test_ratings_and_tags(spark):
    r = loaders.parse_rating_lines(lines(spark, "1,2,3.5,1193435061")).first()
    assert (r.uid, r.mid, r.score, r.timestamp) == (1, 2, 3.5, 1193435061)
    t = loaders.parse_tag_lines(lines(spark, "23,150,Ron Howard ,1148672905")).first()
    assert t.tag == "Ron Howard "  # tags are not trimmed


def test_malformed_messages_are_dropped_or_flagged(spark):
    msgs = lines(spark, " 1 | 2 | 4.5 | 100 ", "oops", "1|x|2|3", "1|2|3", "4|5|1.0|7", "5|6|2.0|8|", "6|7|3.0|9|x")
    good = loaders.parse_rating_messages(msgs).orderBy("uid").collect()
    assert [(r.uid, r.mid, r.score, r.ts) for r in good] == [(1, 2, 4.5, 100), (4, 5, 1.0, 7), (5, 6, 2.0, 8), (6, 7, 3.0, 9)]
    flagged = loaders.parse_rating_messages(msgs, keep_bad=True)
    assert sorted(r.value for r in flagged.where("not _ok").collect()) == ["1|2|3", "1|x|2|3", "oops"]


@pytest.mark.parametrize("parse, line", [
    (loaders.parse_rating_lines, "1,2"), (loaders.parse_rating_lines, "1,x,3.0,4"), (loaders.parse_tag_lines, "1,2,tag"),
    (loaders.parse_movie_lines, "7^x"), (loaders.parse_movie_lines, "a^^^^^^^^^")])
def test_bad_lines_fail(spark, parse, line):
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="fewer than|not a valid"):
                parse(lines(spark, line)).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_surplus_fields_are_ignored(spark):
    r = loaders.parse_rating_lines(lines(spark, "1,2,3.5,4,5")).first()
    assert (r.uid, r.mid, r.score, r.timestamp) == (1, 2, 3.5, 4)


def test_messages_pass_extra_columns(spark):
    msgs = spark.createDataFrame([("1|2|3.0|4", 99)], "value string, event_id long")
    r = loaders.parse_rating_messages(msgs).first()
    assert r.event_id == 99 and r.uid == 1


def test_render_then_load_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3.5, 10), (4, 5, 1.0, 20)], "uid int, mid int, score double, timestamp long")
    path = str(tmp_path / "r")
    loaders.render_lines(df, ",").write.text(path)
    back = loaders.load_ratings(spark, path).orderBy("uid").collect()
    assert [tuple(r) for r in back] == [(1, 2, 3.5, 10), (4, 5, 1.0, 20)]


SF = "/root/testdata/sf0.001"


def test_catalog_table_is_joined_as_it_lies(spark):
    """The anti join shuffles the tags only; the stored pairs keep their buckets."""
    from reelrank.plans.queries import QUERIES
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["unrated_tags"](spark, SF)
        df.collect()
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
    join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert join > 0 and not any("Exchange" in line or "Shuffle" in line for line in above[:join])
