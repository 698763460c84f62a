import os

import pytest
from conftest import rows
from pages import TE_ACTUAL, TE_ROWS, table
from pyspark.sql import functions as F

from seasonline.plans import history
from seasonline.plans.history import build_history, build_scoring_season, history_quality, read_history, read_quarantine
from seasonline.plans.queries import incremental_pages, url_facets
from seasonline.sources.lines import from_comma_text, read_stat_lines
from seasonline.sources.sinks import write_grid, write_master, write_scores, write_season_text, write_seasons
from seasonline.streaming.pages import latest_loads, load_history, load_new_pages, stream_pages

LINES = "Name string, Yr int, pos string, kind string, FPts double"


def files_of(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_rerun_replaces_only_its_own_partitions(spark, tmp_path):
    path = str(tmp_path / "seasons")
    lines = spark.createDataFrame([("a", y, "TE", k, float(y)) for y in (2010, 2011) for k in ("projected", "actual")], LINES)
    write_seasons(lines, path)
    write_seasons(lines, path)
    assert rows(spark.read.parquet(path).select(lines.columns)) == rows(lines)
    newer = spark.createDataFrame([("b", 2011, "TE", "actual", 1.0)], LINES)
    write_seasons(newer, path)
    stored = spark.read.schema(LINES).parquet(path)
    assert rows(stored.where("Yr = 2011 and kind = 'actual'").select("Name")) == [("b",)]
    assert stored.count() == 4
    assert {os.path.dirname(f) for f in files_of(path)} == {f"Yr={y}/pos=TE/kind={k}" for y in (2010, 2011) for k in ("projected", "actual")}


def test_comma_files_read_back_by_path(spark, tmp_path):
    source = from_comma_text(
        spark.createDataFrame(
            [
                ("TE", "projected", 2010, "Al,KC,5.0,1.0,2.0,3.0,4.5"),
                ("TE", "actual", 2011, "Al,KC,2011.0,16.0,99.0,1.0,2.0,3.0,-4.5,1.1"),
                ("RB", "projected", 2011, "Bo,FA,2011.0,-,1.0,2.0,3.0,4.0,5.0,6.0,7.0"),
            ],
            "pos string, kind string, season_hint int, value string",
        )
    )
    path = str(tmp_path / "files")
    write_season_text(source, path)
    assert {os.path.dirname(f) for f in files_of(path)} == {"file=TE_projected_2010", "file=TE_actual_2011", "file=RB_projected_2011"}
    assert rows(spark.read.text(path).where("file like 'TE_act%'").select("value")) == [("Al,KC,2011.0,16.0,,1.0,2.0,3.0,-4.5,",)]
    assert rows(read_stat_lines(spark, path)) == rows(source)


def test_master_holds_a_range(spark, tmp_path):
    lines = spark.createDataFrame([("a", y, "TE", "actual", 1.0) for y in range(2009, 2014)], LINES)
    write_master(lines, str(tmp_path / "m"), 2010, 2012)
    assert rows(spark.read.parquet(str(tmp_path / "m")).select("Yr")) == [(2010,), (2011,), (2012,)]


def test_scores_are_text_with_a_header(spark, tmp_path):
    path = tmp_path / "scores"
    data = [("Al, Bo", 1.5, 2.25, 2019, "TE", run) for run in (0, 1)]
    scores = spark.createDataFrame(data, "Player string, Projection double, `My Computed Score` double, Yr int, pos string, run int")
    write_scores(scores, str(path))
    files = files_of(path)
    assert [os.path.dirname(f) for f in files] == ["Yr=2019/pos=TE/run=0", "Yr=2019/pos=TE/run=1"]
    assert (path / files[0]).read_text() == 'Player,Projection,My Computed Score\n"Al, Bo",1.5,2.25\n'


def test_grid_sink_keeps_the_page(spark, tmp_path):
    grid = spark.createDataFrame([(2010, 0, 0, "a"), (2010, 1, 0, "b")], "yr int, page int, row_no int, text string")
    write_grid(grid, str(tmp_path / "g"), by=["yr"])
    assert rows(spark.read.parquet(str(tmp_path / "g")).select(grid.columns)) == rows(grid)


def url(kind, yr, page):
    head = "rankings/list.php?&PosID=40&Season={}" if kind == "projected" else "stats/list.php?Season={}&GameWeek=&PosID=40"
    return "http://www.example.com/" + head.format(yr) + f"&LeagueID=1&cur_page={page}"


def fetched(spark):
    pages = [(1, url("projected", yr, 0), table(TE_ROWS, "smallbody")) for yr in (2014, 2015)]
    pages += [(2, url("projected", 2015, 1), table([TE_ROWS[0]], "smallbody")), (3, url("actual", 2015, 0), table(TE_ACTUAL, "sort1"))]
    pages += [(4, url("actual", 2014, 0), table([], "sort1")), (5, url("actual", 2013, 0), "<p>gone</p>")]
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_history_from_pages(spark, tmp_path):
    path = str(tmp_path / "history")
    build_history(fetched(spark), path, 2015, 2015)
    lines = read_history(spark, path, 2010, 2020)
    assert "width_ok" not in lines.columns
    assert rows(lines.groupBy("Yr", "kind").count()) == [(2014, "projected", 2), (2015, "actual", 2), (2015, "projected", 3)]
    one = lines.where("Yr = 2015 and kind = 'actual' and Name = 'Al Bo Jr'").first()
    assert (one["GP"], one["Rec"], one["Rec Yds"], one["FPts"], one["pos"], one["page"]) == (16, 80.0, 1024.0, 200.5, "TE", 0)
    assert spark.read.parquet(f"{path}/masters/2015-2015").count() == 5
    assert rows(spark.read.parquet(f"{path}/quarantine/pages").select("page_id", "reason")) == [(5, "no table")]
    quality = {tuple(r)[:4]: tuple(r)[4:] for r in history_quality(fetched(spark)).collect()}
    assert quality[2015, "TE", "projected", 0] == (1, 0, 0, 14)
    assert quality[2014, "TE", "actual", 0] == (1, 1, 0, 0) and quality[2013, "TE", "actual", 0] == (1, 1, 1, 0)


def test_nothing_is_lost_between_pages_and_history(spark, tmp_path):
    """Unknown pages, short records and a second load: every row is stored or in quarantine."""
    path = str(tmp_path / "history")
    odd = [
        (6, url("projected", 2015, 0).replace("PosID=40", "PosID=77"), table(TE_ROWS, "smallbody")),
        (7, "http://www.example.com/other", table(TE_ROWS, "smallbody")),
        (8, None, table(TE_ROWS, "smallbody")),
        (9, url("projected", 2016, 0), table([TE_ROWS[0], ["Zed, Jr", "SD", "5"]], "smallbody")),
    ]
    pages = fetched(spark).unionByName(spark.createDataFrame(odd, "page_id long, url string, html string"))
    build_history(pages, path, 2015, 2015)
    missing = spark.read.parquet(f"{path}/quarantine/pages").select("page_id", "reason")
    assert rows(missing) == [(5, "no table"), (6, "unknown page"), (7, "unknown page"), (8, "unknown page")]
    records = read_quarantine(spark, path, "records", "yr int, pos string, kind string, page int, raw string")
    assert rows(records) == [(2016, "TE", "projected", 0, "Zed Jr,SD,2016.0,5.0")]
    before = rows(read_history(spark, path, 2010, 2020).select("Yr", "kind", "page", "Name"))
    assert len(before) == 2 + 2 + 1 + 2 + 1

    again = [(1, url("projected", 2015, 1), table([TE_ROWS[1]], "smallbody")), (2, url("actual", 2015, 0), table([], "sort1"))]
    build_history(spark.createDataFrame(again, "page_id long, url string, html string"), path, 2015, 2015)
    after = rows(read_history(spark, path, 2010, 2020).select("Yr", "kind", "page", "Name"))
    changed = [r for r in before if r[:3] not in ((2015, "projected", 1), (2015, "actual", 0))]
    assert after == sorted([*changed, (2015, "projected", 1, "Cy D'Oh")])
    assert spark.read.parquet(f"{path}/masters/2015-2015").count() == 3


def test_history_prunes_seasons(spark, tmp_path):
    path = str(tmp_path / "history")
    build_history(fetched(spark), path, 2014, 2015)
    plan = read_history(spark, path, 2015, 2015)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Yr" in plan


def test_scoring_season_from_pages(spark, tmp_path):
    path = str(tmp_path / "scoring")
    build_scoring_season(fetched(spark), path, 2015)
    assert rows(spark.read.parquet(path).select("Yr", "kind", "GP")) == [(2015, "projected", 16)] * 3


def test_stream_reads_each_file_once_and_newer_pages_win(spark, tmp_path):
    source, sink, progress = (str(tmp_path / d) for d in ("source", "sink", "progress"))

    def load():
        pages = stream_pages(spark, source, "page int, text string", files_per_batch=1)
        load_new_pages(pages, lambda batch: batch, sink, progress)
        return spark.read.parquet(sink)

    spark.createDataFrame([(0, "old"), (1, "same")], "page int, text string").coalesce(1).write.parquet(source)
    assert load().count() == 2
    assert load().count() == 2
    spark.createDataFrame([(0, "new"), (2, "more")], "page int, text string").coalesce(1).write.mode("append").parquet(source)
    stored = load()
    assert stored.count() == 4
    assert rows(latest_loads(stored, ["page"]).select("page", "text")) == [(0, "new"), (1, "same"), (2, "more")]


def test_a_page_that_became_empty_loses_its_lines(spark, tmp_path):
    source, sink, progress, loads = (str(tmp_path / d) for d in ("source", "sink", "progress", "loads"))
    for text in ("a b", ""):
        spark.createDataFrame([(0, text), (1, "c")], "page int, text string").coalesce(1).write.mode("append").parquet(source)
        pages = stream_pages(spark, source, "page int, text string")
        words = lambda batch: batch.select("page", F.explode(F.split("text", " ")).alias("w")).where("w <> ''")
        load_new_pages(pages, words, sink, progress, page_keys=["page"], loads=loads)
    stored = spark.read.parquet(sink)
    assert rows(latest_loads(stored, ["page"]).select("page", "w")) == [(0, "a"), (0, "b"), (1, "c")]
    assert rows(latest_loads(stored, ["page"], spark.read.parquet(loads)).select("page", "w")) == [(1, "c")]


def one_page(spark, page_id, kind, yr, page, records):
    cell = "smallbody" if kind == "projected" else "sort1"
    body = table(records, cell) if records is not None else "<p>gone</p>"
    return spark.createDataFrame([(page_id, url(kind, yr, page), body)], "page_id long, url string, html string")


def test_a_load_writes_only_the_seasons_it_changes(spark, tmp_path):
    path, master = str(tmp_path / "history"), str(tmp_path / "history/masters/2014-2015")
    build_history(fetched(spark), path, 2014, 2015)
    before = files_of(master)
    assert {f.rsplit("/", 1)[0] for f in before if "Yr=2014" in f} == {"pos=TE/kind=projected/Yr=2014"}
    build_history(one_page(spark, 2, "projected", 2015, 1, []), path, 2014, 2015)
    after = files_of(master)
    assert [f for f in after if "Yr=2014" in f] == [f for f in before if "Yr=2014" in f]
    assert not {f for f in after if "Yr=2015" in f} & {f for f in before if "Yr=2015" in f}
    assert rows(spark.read.parquet(master).groupBy("Yr", "kind").count()) == rows(read_history(spark, path, 2014, 2015).groupBy("Yr", "kind").count())
    # A season that has no rows of a kind any more loses the folder.
    build_history(one_page(spark, 3, "actual", 2015, 0, []), path, 2014, 2015)
    assert rows(spark.read.parquet(master).groupBy("Yr", "kind").count()) == [(2014, "projected", 2), (2015, "projected", 2)]
    # Another range has a master of its own, whole from the first.
    build_history(one_page(spark, 9, "actual", 2016, 0, TE_ACTUAL), path, 2014, 2016)
    assert spark.read.parquet(f"{path}/masters/2014-2016").count() == 6


def test_a_load_that_fails_half_way_leaves_the_old_master(spark, tmp_path, monkeypatch):
    path, master = str(tmp_path / "history"), str(tmp_path / "history/masters/2014-2015")
    build_history(fetched(spark), path, 2014, 2015)
    before = rows(spark.read.parquet(master).select("Yr", "kind", "Name"))
    again = one_page(spark, 1, "projected", 2014, 0, [TE_ROWS[1]])
    with monkeypatch.context() as broken:

        def fail(*_, **__):
            raise RuntimeError("lost")

        broken.setattr(history, "write_master_seasons", fail)
        try:
            build_history(again, path, 2014, 2015, name="pages.7")
        except RuntimeError:
            pass
    assert rows(spark.read.parquet(master).select("Yr", "kind", "Name")) == before
    # The next load, of another season, also brings what the failed one has left undone.
    build_history(one_page(spark, 5, "actual", 2013, 0, None), path, 2014, 2015)
    assert rows(spark.read.parquet(master).where("Yr = 2014").select("Name")) == [("Cy D'Oh",)]


def test_a_batch_done_again_replaces_itself(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "history")
    with monkeypatch.context() as broken:
        done = history.write_partitioned

        def fails_at_the_list(df, where, by, **options):
            if where.endswith("/loads"):
                raise RuntimeError("lost")
            done(df, where, by, **options)

        broken.setattr(history, "write_partitioned", fails_at_the_list)
        try:
            build_history(fetched(spark), path, 2014, 2015, name="pages.0")
        except RuntimeError:
            pass
    assert spark.read.parquet(f"{path}/seasons").count() == 7
    for _ in range(2):
        build_history(fetched(spark), path, 2014, 2015, name="pages.0")
        assert rows(read_history(spark, path, 2010, 2020).groupBy("Yr", "kind").count()) == [
            (2014, "projected", 2), (2015, "actual", 2), (2015, "projected", 3),
        ]
        assert spark.read.parquet(f"{path}/loads").select("load_id").distinct().count() == 1
        assert read_quarantine(spark, path, "pages", "page_id long", superseded=True).count() == 1
    build_history(one_page(spark, 2, "projected", 2015, 1, []), path, 2014, 2015)
    loads = [r[0] for r in spark.read.schema("load_id string").parquet(f"{path}/loads").distinct().orderBy("load_id").collect()]
    assert [x[:20] for x in loads] == [f"{n:020d}" for n in range(2)]


def test_a_stream_builds_the_history(spark, tmp_path):
    source, path, progress = (str(tmp_path / d) for d in ("source", "history", "progress"))
    schema = "page_id long, url string, html string"

    def load():
        load_history(stream_pages(spark, source, schema, files_per_batch=1), path, progress, 2014, 2015)
        return rows(read_history(spark, path, 2010, 2020).groupBy("Yr", "kind").count())

    fetched(spark).coalesce(1).write.parquet(source)
    first = load()
    assert first == [(2014, "projected", 2), (2015, "actual", 2), (2015, "projected", 3)]
    assert load() == first
    one_page(spark, 3, "actual", 2015, 0, []).coalesce(1).write.mode("append").parquet(source)
    one_page(spark, 5, "actual", 2013, 0, TE_ACTUAL).coalesce(1).write.mode("append").parquet(source)
    assert load() == [(2013, "actual", 2), (2014, "projected", 2), (2015, "projected", 3)]
    assert read_quarantine(spark, path, "pages", "page_id long").count() == 0
    assert spark.read.parquet(f"{path}/masters/2014-2015").count() == 5


def test_what_a_later_load_sets_right_leaves_the_quarantine(spark, tmp_path):
    path = str(tmp_path / "history")
    unknown = url("projected", 2015, 0).replace("PosID=40", "PosID=77")
    short = [TE_ROWS[0], ["Zed", "SD", "5"]]
    odd = spark.createDataFrame(
        [(6, unknown, "x"), (8, None, "y"), (9, None, "z")], "page_id long, url string, html string"
    ).unionByName(one_page(spark, 7, "projected", 2016, 0, short)).unionByName(one_page(spark, 5, "actual", 2013, 0, None))
    for _ in range(2):  # the same faults again stay one entry, but where there is no address to tell a page by
        build_history(odd, path, 2015, 2015)
    pages = "page_id long, reason string"
    missing = read_quarantine(spark, path, "pages", pages)
    assert rows(missing) == sorted([(5, "no table"), (6, "unknown page"), *[(n, "unknown page") for n in (8, 9) for _ in range(2)]])
    records = "yr int, page int, raw string"
    assert rows(read_quarantine(spark, path, "records", records)) == [(2016, 0, "Zed,SD,2016.0,5.0")]
    mended = one_page(spark, 7, "projected", 2016, 0, TE_ROWS).unionByName(one_page(spark, 5, "actual", 2013, 0, TE_ACTUAL))
    build_history(mended, path, 2015, 2015)
    assert read_quarantine(spark, path, "records", records).count() == 0
    assert {r["page_id"] for r in read_quarantine(spark, path, "pages", pages).collect()} == {6, 8, 9}
    assert read_quarantine(spark, path, "records", records, superseded=True).count() == 2
    assert rows(read_history(spark, path, 2010, 2020).groupBy("Yr").count()) == [(2013, 2), (2016, 2)]


def test_scoring_season_keeps_what_does_not_fit(spark, tmp_path):
    path = str(tmp_path / "scoring")
    odd = one_page(spark, 6, "projected", 2015, 7, [TE_ROWS[0], ["Zed", "SD", "5"]]).unionByName(one_page(spark, 7, "projected", 2015, 8, None))
    odd = odd.unionByName(spark.createDataFrame([(8, "http://www.example.com/other", "x")], odd.schema))
    build_scoring_season(fetched(spark).unionByName(odd), path, 2015)
    assert spark.read.parquet(path).count() == 4
    assert spark.read.parquet(path).where("Name is null").count() == 0
    assert rows(spark.read.parquet(f"{path}/_quarantine/records").select("page", "raw")) == [(7, "Zed,SD,2015.0,5.0")]
    assert rows(spark.read.parquet(f"{path}/_quarantine/pages").select("page_id", "reason")) == [(7, "no table"), (8, "unknown page")]


@pytest.mark.parametrize("kind", ["file", "folder", "empty"])
def test_page_facets_come_from_a_file_or_a_folder(spark, tmp_path, kind):
    """A table may be one file or a folder of parts, and may hold no row."""
    pages = [(i, f"http://h{i}.example/en/item/{i}?page={i}&ref=r", "<p>") for i in range(20 * (kind != "empty"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    if kind == "file":
        df.coalesce(1).write.parquet(f"{tmp_path}/parts")
        next((tmp_path / "parts").glob("*.parquet")).rename(tmp_path / "pages.parquet")
    else:
        df.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    found = incremental_pages(spark, str(tmp_path))
    assert rows(found) == rows(url_facets(spark, str(tmp_path))) and found.count() == len(pages)
    assert found.dtypes == url_facets(spark, str(tmp_path)).dtypes
