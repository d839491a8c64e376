"""Files of differing headers, rejected rows and repeated deliveries."""

import pytest

from tests.conftest import day
from tidecast.sources import daily

FILES = {
    "news_2024-01-01.csv": 'title,article,date,media\n"One","first\nline, ""quoted""",2024-01-01,a\n"Two",\\N,2024-01-01,b\n',
    "news_2024-01-02.csv": "media,date,extra,title\na,2024-01-02,x,Three\nb,not a day,y,Four\nc,2024-01-02,z,Five,more\n",
    "news_2024-01-03.csv": "date,media,title,article\n",
    "news_2024-01-04.csv": "",
    "news_2024-01-05.csv": "media,media2\nm,1\nmedia,media2\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


@pytest.mark.parametrize("multi_line", [True, False])
def test_headers_may_differ_and_bad_rows_are_set_aside(spark, folder, multi_line):
    drops = daily.read_drops(spark, f"{folder}/*.csv", daily.ARTICLE_SCHEMA, multi_line)
    got = sorted((tuple(r) for r in drops.rows.collect()), key=repr)
    sure = [("Three", None, day(2), "a"), (None, None, None, "m"), ("Two", None, day(1), "b")]
    if multi_line:
        assert got == sorted([*sure, ("One", 'first\nline, "quoted"', day(1), "a")], key=repr)
    else:
        assert set(sure) <= set(got)
    rejected = [(r["file"].rpartition("/")[2], r["reason"], r["cells"]) for r in drops.rejected.collect()]
    assert sorted(r for r in rejected if "01-02" in r[0]) == [
        ("news_2024-01-02.csv", "date is no date", ["b", "not a day", "y", "Four"]),
        ("news_2024-01-02.csv", "more cells than the header", ["c", "2024-01-02", "z", "Five", "more"]),
    ]
    assert drops.rows.dtypes == [("title", "string"), ("article", "string"), ("date", "date"), ("media", "string")]


def test_large_files_are_split_and_keep_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,k\n" + "".join(f"{i},a\n" for i in range(40_000)))
    (tmp_path / "b.csv").write_text("k,n\n" + "".join(f"b,{i}\n" for i in range(40_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = daily.read_drops(spark, str(tmp_path), "k string, n long", multi_line=False).rows
        assert sorted(tuple(r) for r in rows.groupBy("k").agg({"n": "sum"}).collect()) == [(k, 40_000 * 39_999 // 2) for k in "ab"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_day_has_one_delivery(spark, folder, tmp_path):
    assert daily.read_drop(spark, folder, daily.ARTICLE_SCHEMA, day(1)).rows.count() == 2
    assert daily.read_drop(spark, folder, daily.ARTICLE_SCHEMA, day(3)).rows.count() == 0
    with pytest.raises(daily.NoData):
        daily.read_drop(spark, folder, daily.ARTICLE_SCHEMA, day(9))
    (tmp_path / "again_2024-01-01.csv").write_text(FILES["news_2024-01-01.csv"])
    with pytest.raises(daily.SeveralDeliveries):
        daily.read_drop(spark, folder, daily.ARTICLE_SCHEMA, day(1))
