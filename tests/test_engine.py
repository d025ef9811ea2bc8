"""Functions, operators and the stages from end to end, on small cases."""

import csv
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.functions.fingerprint import fingerprint64
from corvane.functions.segment import sentences as split_sentences
from corvane.functions.text import normal_form
from corvane.operators import acquire, candidates, ingest, matching, rules
from corvane.operators.ingest import InputError
from corvane.plans import registry
from corvane.plans.stages import Config, Work
from corvane.sources import files


def test_fingerprints():
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    assert [signed(fingerprint64(x)) for x in (b"1footrue", b"2applefalse", b"3true")] == [-1541654101129638711, 2794438866806483259, -4880158226897771312]
    assert len({fingerprint64(b"ab" * n) for n in range(100)}) == 100


@given(st.text())
@settings(max_examples=200, deadline=None)
def test_normal_form_is_stable(text):
    once = normal_form(text)
    assert normal_form(once) == once or "ß" in text or normal_form(normal_form(once)) == normal_form(once)


def test_normal_form_and_sentences():
    assert normal_form(" Ｆ‑16’s  STRAẞE ") == "f-16's strasse"
    assert split_sentences("Gen. Smith came. He left! Why?") == ["Gen. Smith came.", "He left!", "Why?"]


def test_whole_texts_are_normalised(spark, tmp_path):
    texts = ["Ｆ‑16’s  STRAẞE – é漢", " a\u2003B\n\tc ", "ﬁn ²", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["plain"] for r in registry.QUERIES["text_norm_whole"](spark, str(tmp_path)).collect()}
    assert got == {i: normal_form(x) for i, x in enumerate(texts)} and got[0] == "f-16's strasse - é漢"


def test_boundaries(spark):
    rows = [(0, "f-16"), (1, "the f-16's wing"), (2, "'f-16'"), (3, "f-16, f-16"), (4, "ak-47 ak"), (5, "no"), (6, "(x) y"), (7, "a a a"), (8, "&& x&&& &&"), (9, r"q\E. q\E")]
    terms = [("a a", "A A", "W02"), ("&&", "&&", "W02"), (r"q\e.", "Q", "W02"), (r"q\E", "QE", "W02"), ("f-16", "F-16", "W05"), ("ak", "AK", "W06"), ("ak-47", "AK-47", "W06"), ("(x) y", "(X) Y", "W01")]
    texts = spark.createDataFrame(rows, "i int, text string")
    found = {(r["i"], r["name"], r["start"], r["end"]) for r in matching.locate(texts, spark.createDataFrame(terms, "term string, name string, category_id string")).collect()}
    assert found == {(0, "F-16", 0, 4), (3, "F-16", 0, 4), (3, "F-16", 6, 10), (4, "AK-47", 0, 5), (4, "AK", 6, 8), (6, "(X) Y", 0, 5), (7, "A A", 0, 3), (7, "A A", 2, 5), (8, "&&", 0, 2), (8, "&&", 5, 7), (8, "&&", 8, 10), (9, "QE", 0, 3), (9, "QE", 5, 8)}


def test_locations_and_dyads(spark):
    plan = candidates.plan_table(spark, [candidates.Conflict("b", "c", ("A", "X"), ("B",))])
    rows = spark.createDataFrame([("A", "B"), ("B", "A"), ("X", "B"), ("A", "A"), (None, "B"), ("A", "X")], "Actor1CountryCode string, Actor2CountryCode string")
    both = [sorted((r[0], r[1]) for r in f(rows, plan).select("Actor1CountryCode", "Actor2CountryCode").collect()) for f in (candidates.tag, candidates.tag_by_sides)]
    assert both[0] == both[1] == [("A", "B"), ("B", "A"), ("X", "B")]
    places = [("k", "u", "g1", "p", 1, None, None, 9, 1), ("k", "u", "g2", "p", 1, 1.0, 1.0, 2, 5), ("k", "u", "g3", "p", 1, 2.0, 2.0, 2, 4), ("k", "v", None, None, None, None, None, 1, 1)]
    counts = spark.createDataFrame(places, "candidate_conflict_id string, source_url string, geo_country_code string, geo_fullname string, geo_type int, geo_lat double, geo_long double, n long, first_day int")
    assert {(r["source_url"], r["geo_country_code"], r["location_count"]) for r in candidates.top_locations(counts).collect()} == {("u", "g3", 3), ("v", None, 1)}


def test_rules(spark):
    usage = rules.patterns(spark.createDataFrame([("P1", "used", None), ("P2", "can be used", ""), ("P3", "no", ""), ("P4", "launched", "may launch")], "pattern_id string, base_form string, trans_form string"))
    cases = [
        ("The army used the F-16 aircraft.", "F-16", "W05", 0, "rule_classification"),
        ("The army did not say it used the F-16 aircraft.", "F-16", "W05", 1, "rule_classification"),
        ("The F-16 aircraft can be used.", "F-16", "W05", 1, "rule_classification"),
        ("It is unclear whether they launched an F-16 aircraft.", "F-16", "W05", 2, "rule_classification"),
        ("The army used guns; the F-16 aircraft stayed.", "F-16", "W05", 2, "usage_expression_in_other_clause_or_relation_unclear"),
        ("An F-16 aircraft flew.", "F-16", "W05", None, "no_usage_pattern"),
        ("They used 747 aircraft.", "747", "W05", None, "literal_match_without_supported_weapon_reference"),
        ("They used an F-16 today.", "F-16", "W05", 2, "weapon_context_unresolved"),
        ("The F-16 aircraft used here was shot down.", "F-16", "W05", 2, "weapon_as_target_does_not_establish_its_use"),
        ("The Lancer aircraft was used.", "Lancer", "W05", 2, "single_word_weapon_name_requires_review"),
        ("Troops used drone swarms.", "AI", "T01", None, "absent"),
    ]
    rows = []
    for k, (sentence, name, category, _, _) in enumerate(cases):
        at = normal_form(sentence).find(normal_form(name))
        if at >= 0:
            rows.append((k, "u", k, sentence, name, category, at, at + len(name)))
    matches = spark.createDataFrame(rows, "match_id long, url string, sentence_no int, sentence string, matched_name string, category_id string, start_pos int, end_pos int")
    got = {r["match_id"]: (r["usage_code"], r["reason"]) for r in rules.decide(matches, usage).collect()}
    assert got == {k: c[3:] for k, c in enumerate(cases) if c[4] != "absent"}


def _site():
    from corvane.operators.acquire import Response

    class Site:
        """A small network: robots rules and a few pages."""

        def one(self, to):
            url = to.url
            if url.endswith("/robots.txt"):
                return Response(url, 404 if "open" in url else 200, {}, b"User-agent: *\nDisallow: /private")
            if "moved" in url:
                return Response(url, 302, {"location": "/"}, b"")
            body = "<html><head><title>F-16 story</title></head><body><div class='related box'>noise</div><p>" + "The army used the F-16 aircraft yesterday. " * 12 + "</p></body></html>"
            return Response(url, 404 if "gone" in url else 200, {"content-type": "text/html"}, body.encode())

    return Site


def _aim():
    def aimed(url):
        from corvane.operators.acquire import Target

        return Target(url, "host", 443, "192.0.2.1")

    return aimed


def _work(tmp_path, spark):
    rows = [("a1", "c1", "2024-01-02", "https://open.example/news/f16", "t"), ("a2", "c1", "2024-01-03", "https://open.example/news/f16#x", "t"), ("a3", "c1", "2024-01-03", "https://open.example/gone/1", "t"), ("a4", "c1", "2024-01-03", "https://bars.example/private/1", "t"), ("a5", "c1", "2024-01-03", "https://open.example/moved/1", "t"), ("a6", "c2", "", "https://open.example/news/f16", "t"), ("a7", "c2", "2024-01-03", "nowhere", "t")]
    files.write_csv(tmp_path / "in.csv", files.INPUT_HEADER, rows)
    sources = tmp_path / "sources"
    files.write_csv(sources / "sipri_dictionary.csv", ["wp_name", "category_id"], [("F-16", "W05"), ("Lancer", "W05")])
    files.write_csv(sources / "nato_dictionary.csv", ["tech_name", "category_id"], [("drone swarm", "T01")])
    files.write_csv(sources / "usage_patterns.csv", ["pattern_id", "base_form", "trans_form"], [("P1", "used", "")])
    (tmp_path / "config.json").write_text(json.dumps({"input_csv": "in.csv", "sources_dir": "sources", "work_dir": "work", "buckets": 4}))
    return Work(spark, Config.load(str(tmp_path / "config.json")))


def test_stages(spark, tmp_path):
    work = _work(tmp_path, spark)
    with pytest.raises(InputError):
        work.run("match")
    work.run("prepare")
    how = {"transport": _site(), "partitions": 2, "wave": 2, "aim": _aim(), "sleep": lambda s: None}
    assert work.run("collect", limit=3, **how)["pages"]["pending"] == 2
    assert work.manifest.get("progress") == {"waves": 2, "fetched": 3}
    (tmp_path / "work/STOP").touch()
    assert work.run("collect", **how)["pages"]["pending"] == 2
    (tmp_path / "work/STOP").unlink()
    report = work.run("collect", wave=2, transport=_site(), partitions=2, aim=_aim(), sleep=lambda s: None)
    assert report["collection_complete"] and report["pages"] == {"extracted": 2, "http_404": 1, "robots_denied": 1, "redirect_to_home": 1, "invalid_url": 1}
    assert work.run("match")["pages_with_matches"] == 2
    with pytest.raises(InputError):
        work.run("collect", transport=_site())
    assert work.run("articles")["excluded"] == {"missing_required_article_field": 1, "same_normalized_url_conflict_title_matching_content": 1}
    assert set(work.run("classify")["codes"]) == {"0", "unclassified"}
    work.run("export")
    with (tmp_path / "work/result.csv").open(encoding="utf-8-sig", newline="") as file:
        assert [r[:3] for r in csv.reader(file)] == [list(files.RESULT_HEADER[:3]), ["a1", "W05", "0"]]
    assert work.run("validate")["checks"] == 10
    assert work.run("status")["done"] == ["prepare", "collect", "match", "articles", "classify", "export"]
    files.write_csv(tmp_path / "work/result.csv", files.RESULT_HEADER, [("a1", "W05", 1, "x")])
    with pytest.raises(InputError, match="result.csv"):
        work.run("validate")


def test_strict_input(spark, tmp_path):
    for k, text in enumerate(["", "article_id,conflict_id\n1,2\n", "article_id,conflict_id,published_date,article_url,title\n,a,b,c,d\n", "article_id,conflict_id,published_date,article_url,title\n1,a,b,c,d\n1,a,b,c,d\n"]):
        path = tmp_path / f"{k}.csv"
        path.write_text(text)
        with pytest.raises(Exception):  # noqa: B017
            files.read_candidates(spark, str(path)).count()


def test_feed_to_export(spark, tmp_path):
    from corvane.plans import feed

    assert [c.batch_id for c in feed.plan()][:1] == ["ucdp_164_20160101_20260923"] and len(feed.plan()) == 15
    day = "2020-05-01"
    event = lambda i, a, b, **x: {"GLOBALEVENTID": i, "SQLDATE": 20200501, "DATEADDED": 20200501, "Actor1Name": "", "Actor2Name": "", "Actor1CountryCode": a, "Actor2CountryCode": b, "EventCode": "190", "EventRootCode": "19", "QuadClass": 4, "ActionGeo_CountryCode": "UP", "ActionGeo_FullName": "p", "ActionGeo_Type": 1, "ActionGeo_Lat": 1.0, "ActionGeo_Long": 2.0, "partition_day": day} | x
    mention = lambda i, url: {"GLOBALEVENTID": i, "MentionIdentifier": url, "MentionSourceName": "s", "MentionTimeDate": 20200502101010, "MentionType": 1, "Confidence": 50, "InRawText": 1, "SentenceID": 1, "MentionDocTranslationInfo": "", "partition_day": day}
    for name, rows in {"events": [event(1, "RUS", "UKR"), event(2, "YEM", "GBR"), event(3, "RUS", "FRA"), event(4, "RUS", "UKR", QuadClass=1)], "mentions": [mention(1, "https://a.example/1"), mention(1, "ftp://a.example/1"), mention(2, "https://a.example/1"), mention(4, "https://a.example/4")]}.items():
        spark.createDataFrame(rows).write.partitionBy("partition_day").parquet(str(tmp_path / "feed" / name))
    (tmp_path / "config.json").write_text(json.dumps({"feed": f"file://{tmp_path}/feed", "dataset": f"file://{tmp_path}/data", "input_csv": "in.csv", "sources_dir": "s", "work_dir": "w"}))
    for _ in range(2):
        report = feed.candidate_articles(spark, feed.FeedConfig.load(str(tmp_path / "config.json")))
        assert (report["candidates_raw"], report["candidate_urls"], report["file"]["rows"]) == (2, 2, 2)
    rows = files.read_candidates(spark, str(tmp_path / "in.csv")).collect()
    feed.bucketed(spark, f"file://{tmp_path}/feed", "study", 4)
    config = json.loads((tmp_path / "config.json").read_text()) | {"bucketed_tables": "study", "input_csv": "again.csv"}
    (tmp_path / "again.json").write_text(json.dumps(config))
    assert feed.candidate_articles(spark, feed.FeedConfig.load(str(tmp_path / "again.json")))["candidate_urls"] == 2
    assert (tmp_path / "again.csv").read_bytes() == (tmp_path / "in.csv").read_bytes()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("study_events").join(spark.table("study_mentions"), "GLOBALEVENTID")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("events", "mentions"):
            spark.sql(f"DROP TABLE study_{name}")
    assert sorted((r["conflict_id"], r["published_date"], r["url"]) for r in rows) == [("ucdp_13243", "2020-05-02", "https://a.example/1"), ("ucdp_16099", "2020-05-02", "https://a.example/1")]


def test_unsafe_addresses():
    local = lambda host, port: [(0, 0, 0, "", ("127.0.0.1", port))]
    for url in ("ftp://a.example/", "https://u@a.example/", "https://a.example/"):
        with pytest.raises(acquire.UnsafeAddress):
            acquire.target(url, local)
    wide = lambda host, port: [(0, 0, 0, "", ("93.184.216.34", port)), (0, 0, 0, "", ("93.184.216.35", port))]
    assert acquire.target("http://a.example/x", wide) == acquire.Target("http://a.example/x", "a.example", 80, "93.184.216.34")
    assert not acquire.public([]) and not acquire.public(["93.184.216.34", "10.0.0.1"])


def test_redirects_are_judged_and_bounded():
    class Loop:
        def one(self, to):
            return acquire.Response(to.url, 302, {"location": "/again"}, b"")

    aims = []
    with pytest.raises(ValueError, match="too many"):
        acquire.get(Loop(), "https://a.example/", lambda url: aims.append(url) or _aim()(url))
    assert len(aims) == acquire.MOST_HOPS and aims[1] == "https://a.example/again"


def test_cache_must_hold_bodies(spark):
    schema = "url string, status string, title string, body string, error string, fetched_at timestamp, final_url string, body_sha256 string"
    here = spark.createDataFrame([("u", "pending", None, None, None, None, None, None)], schema)
    good = spark.createDataFrame([("u", "extracted", "t", "b", "", None, "u", "")], schema)
    row = ingest.merge_cache(here, good).first()
    assert (row["status"], row["body"], row["imported"]) == ("extracted", "b", True)
    with pytest.raises(InputError):
        ingest.merge_cache(here, good.withColumn("body", good["error"]))


def test_queue_stream(spark, tmp_path):
    from corvane.streaming.queue import PAGES, drain

    def put(urls):
        spark.createDataFrame([(u, "d", "pending", 1, None) for u in urls], PAGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "q"))

    fetch = lambda batch: batch.select("url")
    for urls in (["a", "b", "a"], ["c"]):
        put(urls)
        drain(spark, str(tmp_path / "q"), str(tmp_path / "o"), str(tmp_path / "c"), fetch)
    assert sorted((r["url"], r["batch"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [("a", 0), ("b", 0), ("c", 1)]


def test_sentences_come_from_every_event(spark, tmp_path):
    from corvane.plans.standins import frame

    spark.createDataFrame([(x,) for x in (0, 3999, 4000, 99_999)], "event_id long").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert sorted(r["sentence_id"] for r in frame(spark, str(tmp_path), "feed_sentences").collect()) == [0, 3999, 4000, 99_999]
    assert {r["sentence_id"] for r in registry.QUERIES["term_match"](spark, str(tmp_path)).collect()} == {0, 3999, 4000, 99_999}


@pytest.mark.parametrize("name", ["candidate_urls", "pages_first_wins", "fetch_status_ladder", "result_export", "exclusions"])
def test_queries_equal_their_oracles(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no tables here")
    link = duckdb.connect()
    for path in folder.glob("*.parquet"):
        link.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want = link.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, str(folder))
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(map(str, want.project(", ".join(sorted(want.columns))).fetchall()))
    assert rows == sorted(str(tuple(r)) for r in got.select(*sorted(got.columns)).collect())


# ---- work that survives a kill, and state that outlives a wave


class _Killed(Exception):
    pass


def _requests(tmp_path):
    """The requests of a ``_LoggedSite``, in order: time, address."""
    lines = [line.split(" ", 1) for path in tmp_path.glob("requests-*") for line in path.read_text().splitlines()]
    return sorted((float(at), url) for at, url in lines)


def _logged_site(folder):
    def make():
        import os
        import time

        from corvane.operators.acquire import Response

        class Logged:
            def one(self, to):
                with open(f"{folder}/requests-{os.getpid()}", "a") as file:
                    file.write(f"{time.time()} {to.url}\n")
                if to.url.endswith("/robots.txt"):
                    return Response(to.url, 200, {}, b"User-agent: *\nDisallow: /private")
                return Response(to.url, 200, {"content-type": "text/html"}, b"<title>t</title><p>" + b"word " * 100 + b"</p>")

        return Logged()

    return make


def test_waves_take_domains_in_turn_and_remember(spark, tmp_path):
    rows = [(f"a{i}", "c", "2024-01-02", f"https://{'large' if i < 30 else f'small{i % 3}'}.example/p/{i}", "t") for i in range(39)]
    files.write_csv(tmp_path / "in.csv", files.INPUT_HEADER, rows)
    work = Work(spark, Config(str(tmp_path / "in.csv"), str(tmp_path), str(tmp_path / "work"), 4))
    work.prepare()
    how = {"transport": _logged_site(str(tmp_path)), "partitions": 2, "aim": _aim(), "pause": 0.2}
    assert work.collect(wave=12, each=4, limit=12, **how)["pages"] == {"extracted": 12, "pending": 27}
    first = [url for _, url in _requests(tmp_path) if not url.endswith("robots.txt")]
    assert len([u for u in first if "large" in u]) <= 4  # the large domain doesn't hold up the others
    assert {u.split("/")[2] for u in first} == {"large.example", *(f"small{k}.example" for k in range(3))}
    work = Work(spark, Config(str(tmp_path / "in.csv"), str(tmp_path), str(tmp_path / "work"), 4))  # another run
    assert work.collect(wave=12, each=8, **how)["collection_complete"]
    seen = _requests(tmp_path)
    asked = [url for _, url in seen if url.endswith("robots.txt")]
    assert len(asked) == len(set(asked)) == 4  # once an origin, over all waves and both runs
    for domain in {url.split("/")[2] for _, url in seen}:
        times = [at for at, url in seen if domain in url and not url.endswith("robots.txt")]
        assert len(times) == (30 if domain == "large.example" else 3)
        assert all(b - a >= 0.19 for a, b in zip(times, times[1:]))


def test_hot_domain_gives_a_wave_few_pages(spark):
    rows = [(f"https://hot.example/{i}", "hot", i) for i in range(10_000)] + [(f"https://d{i}.example/", f"d{i}", 10_000 + i) for i in range(50)]
    got = acquire.wave(spark.createDataFrame(rows, "url string, domain string, row_no long"), 60, 20).groupBy("domain").count().collect()
    counts = {r["domain"]: r["count"] for r in got}
    assert len(counts) == 51 and counts["hot"] == 10 and set(counts.values()) == {1, 10}


def test_date_mismatch_keeps_its_text(spark):
    class Old:
        def one(self, to):
            if to.url.endswith("/robots.txt"):
                return acquire.Response(to.url, 404, {}, b"")
            return acquire.Response(to.url, 200, {"content-type": "text/html"}, b"<title>t</title><meta name='date' content='2020-01-01'><p>" + b"word " * 100 + b"</p>")

    queue = spark.createDataFrame([("https://a.example/1", "a.example", "2024-01-02", 1)], "url string, domain string, expected_date string, row_no long")
    nothing = spark.createDataFrame([], "origin string, domain string, robots_at double, robots_status int, robots_body string, hit_at double")
    row = acquire.fetch_all(acquire.known(acquire.wave(queue, 9, 9), nothing), Old, 1, aim=_aim()).first()
    assert (row["status"], row["error"], row["title"]) == ("article_date_mismatch", "input_date=2024-01-02;extracted_date=2020-01-01", "t")
    assert row["body"].startswith("word word")


def _matched(tmp_path, spark, name):
    folder = tmp_path / name
    rows = [(f"a{i}", f"c{i % 2}", "2024-01-02", f"https://d{i % 5}.example/{i}", "t") for i in range(40)]
    files.write_csv(folder / "in.csv", files.INPUT_HEADER, rows)
    files.write_csv(folder / "sipri_dictionary.csv", ["wp_name", "category_id"], [("F-16", "W05"), ("Lancer", "W05")])
    files.write_csv(folder / "nato_dictionary.csv", ["tech_name", "category_id"], [("drone swarm", "T01")])
    files.write_csv(folder / "usage_patterns.csv", ["pattern_id", "base_form", "trans_form"], [("P1", "used", "")])
    work = Work(spark, Config(str(folder / "in.csv"), str(folder), str(folder / "work"), 8))
    work.run("prepare")
    from pyspark.sql import functions as F

    body = F.concat(F.lit("The army used the F-16 aircraft. A drone swarm was used in "), "row_no", F.lit(" places. The Lancer flew."))
    pages = work.read("pages").withColumns({"status": F.lit("extracted"), "title": F.lit("An F-16"), "body": body})
    work.store.write("pages", pages, "bucket")
    work.manifest.put("collect", {"collection_complete": True})
    return work


def test_matching_and_classifying_go_on_after_a_kill(spark, tmp_path, monkeypatch):
    whole = _matched(tmp_path, spark, "whole")
    broken = _matched(tmp_path, spark, "broken")
    for work in (whole, broken):
        if work is broken:
            for stage, table, done in (("match", "matched_pages", "found"), ("classify", "decided", "decided")):
                if stage == "classify":
                    work.run("articles")
                fill, calls = work.store.fill, []

                def dying(name, rows, by, fill=fill, calls=calls, table=table):
                    calls.append(name)
                    if calls.count(table) == 3:
                        raise _Killed
                    fill(name, rows, by)

                monkeypatch.setattr(work.store, "fill", dying)
                with pytest.raises(_Killed):
                    work.run(stage, together=2)
                monkeypatch.setattr(work.store, "fill", fill)
                before = {x: work.store.names(f"open/{table}/{x}") for x in work.store.names(f"open/{table}") if "=" in x}
                assert len(before) == 4
                with pytest.raises(InputError):
                    work.run("collect")
                work.run(stage, together=2)
                after = {x: work.store.names(f"open/{table}/{x}") for x in work.store.names(f"open/{table}") if "=" in x}
                assert len(after) > 4 and all(after[k] == v for k, v in before.items())  # what was done wasn't written again
        else:
            for stage in ("match", "articles", "classify"):
                work.run(stage)
    for table in ("matches", "decisions"):
        rows = [sorted(map(str, work.read(table).select(sorted(work.read(table).columns)).collect())) for work in (whole, broken)]
        assert rows[0] == rows[1] and rows[0]


def test_tables_change_as_a_whole(spark, tmp_path, monkeypatch):
    from corvane.sources.store import Store, Taken

    store = Store(spark, str(tmp_path / "s"))
    store.make()
    store.write("t", spark.range(3))
    for name in ("put", "rename"):
        with monkeypatch.context() as m:
            m.setattr(store, name, lambda *args, **how: (_ for _ in ()).throw(_Killed))
            with pytest.raises(_Killed):
                store.write("t", spark.range(5))
        assert store.read("t").count() == 3
    store.write("t", store.read("t").filter("id > 0"))  # made of itself
    assert sorted(r["id"] for r in store.read("t").collect()) == [1, 2]
    with pytest.raises(Taken):
        store.write("t", spark.range(1), new=True)
    with pytest.raises(Taken):
        store.put("t.table", "x", new=True)
    assert len(store.names("tables/t")) <= 3


def test_second_prepare_is_refused(spark, tmp_path, monkeypatch):
    work = _work(tmp_path, spark)
    with monkeypatch.context() as m:  # killed before the last table
        m.setattr(work, "_write_pages", lambda *args, **how: (_ for _ in ()).throw(_Killed))
        with pytest.raises(_Killed):
            work.prepare()
    work.prepare()
    with pytest.raises(InputError, match="already"):
        work.prepare()
    value = work.manifest.values | {"codes": "used 1"}
    work.store.put("manifest.json", json.dumps(value))
    with pytest.raises(InputError, match="codes"):
        Work(spark, work.config)


@settings(max_examples=6, deadline=None, derandomize=True)
@given(st.lists(st.tuples(*[st.text(alphabet="ab,\"\n\r é\t", max_size=7)] * 4), min_size=1, max_size=30), st.integers(1, 60))
def test_split_csv_equals_one_reader(spark, tmp_path_factory, rows, size):
    """Quoted values with line ends, cut into splits of a few bytes anywhere."""
    path = tmp_path_factory.mktemp("csv") / "in.csv"
    files.write_csv(path, files.INPUT_HEADER, [(f"i{k}", *row) for k, row in enumerate(rows)])
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "16"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        got = sorted(tuple(r) for r in files.read_candidates(spark, str(path)).collect())
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert got == [(k + 1, f"i{k}", *row) for k, row in enumerate(rows)]


def test_split_csv_refuses(spark, tmp_path):
    head = ",".join(files.INPUT_HEADER)
    for k, text in enumerate([f"{head}\n1,a,b,c\n", f'{head}\n1,a,"b,c,d\n2,a,b,c,d\n', f'{head}\n1,a,"b"x,c,d\n', f"{head},x\n1,a,b,c,d,e\n"]):
        (tmp_path / f"{k}.csv").write_text(text)
        with pytest.raises(Exception):  # noqa: B017
            files.read_candidates(spark, str(tmp_path / f"{k}.csv")).count()
    (tmp_path / "blank.csv").write_text(f"﻿{head}\r\n\r\n1,a,b,c,d\r\n\n2,,,,", encoding="utf-8")
    assert [tuple(r) for r in files.read_candidates(spark, str(tmp_path / "blank.csv")).orderBy("row_no").collect()] == [(1, "1", "a", "b", "c", "d"), (2, "2", "", "", "", "")]


def test_export_equals_the_plain_writer(spark, tmp_path):
    rows = [(k, x, None if k % 3 else "y", k / 4) for k, x in enumerate(["plain", 'a "q"', "a,b", "l\nm", "l\r\nm", "", " s ", None, "é漢", "'"] * 20)]
    frame = spark.createDataFrame(rows, "a long, b string, c string, d double").repartition(5)
    n = files.export_csv(frame.orderBy("a"), tmp_path / "out/spark.csv", list("abcd"))
    files.write_csv(tmp_path / "plain.csv", list("abcd"), rows)
    assert n == len(rows) and (tmp_path / "out/spark.csv").read_bytes() == (tmp_path / "plain.csv").read_bytes()
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["spark.csv"]
    assert files.file_info(spark, tmp_path / "plain.csv", n)["sha256"] == files.digest(spark, str(tmp_path / "out/spark.csv"))


def test_scan_equals_a_search_at_every_place(spark):
    import random

    from pyspark.sql import functions as F

    from corvane.functions.text import bounded

    rng = random.Random(1)
    make = lambda n: "".join(rng.choice("ab-'_ (+)/é漢1 .") for _ in range(n))
    terms = sorted({make(rng.randint(1, 6)) for _ in range(120)} | {"aa aa", "a a", "(a)", "+", "+(", "a+b"})
    texts = [make(rng.randint(0, 40)) for _ in range(300)] + ["aa aa aa aa", "x(a)", "(a)", "(a)(a)", "+", "a+", "+(+(", "a+b+b"]
    token = lambda c: c.isalnum() or c in "_'-"
    want = set()
    for i, text in enumerate(texts):
        for term in terms:
            at = text.find(term)
            while at >= 0:
                end = at + len(term)
                if not (at and token(text[at - 1])) and not (end < len(text) and token(text[end])):
                    want.add((i, term, at, end))
                at = text.find(term, at + 1)
    a, b = spark.createDataFrame(list(enumerate(texts)), "i int, text string"), spark.createDataFrame([(x,) for x in terms], "term string")
    got = [tuple(r) for r in matching.locate(a, b).select("i", "term", "start", "end").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    pairs = a.join(b, F.col("text").contains(F.col("term")))
    assert {tuple(r) for r in pairs.filter(bounded(F.col("text"), F.col("term"))).select("i", "term").collect()} == {x[:2] for x in want}


# ---- each peculiarity of the rules by itself


def _decide(spark, cases, usage=None):
    """usage_code and reason of (sentence, name, category) each."""
    usage = rules.patterns(spark.createDataFrame(usage or [("P1", "used", None)], "pattern_id string, base_form string, trans_form string"))
    rows = []
    for k, (sentence, name, category) in enumerate(cases):
        at = normal_form(sentence).find(normal_form(name))
        rows.append((k, "u", k, sentence, name, category, at, at + len(name)))
    matches = spark.createDataFrame(rows, "match_id long, url string, sentence_no int, sentence string, matched_name string, category_id string, start_pos int, end_pos int")
    got = {r["match_id"]: r for r in rules.decide(matches, usage).collect()}
    return [(got[k]["usage_code"], got[k]["reason"]) for k in range(len(cases))]


def _filler(n):
    return ("zzzzzzzzz " * 20)[: n - 2] + "z "


def test_window_before_a_hit_starts_a_blank_early_after_a_split(spark):
    behind = "used the F-16 aircraft"
    cases = [(f"x; not {_filler(82)}{behind}", "F-16", "W05"), (f"x; not {_filler(83)}{behind}", "F-16", "W05"), (f"not {_filler(82)}{behind}", "F-16", "W05"), (f"not {_filler(81)}{behind}", "F-16", "W05")]
    assert [c for c, _ in _decide(spark, cases)] == [1, 0, 0, 1]


def test_window_that_cuts_a_word_changes_it(spark):
    behind = "used the F-16 aircraft"
    cases = [(f"unlikely {_filler(n)}{behind}", "F-16", "W05") for n in (77, 78, 79)]
    assert [c for c, _ in _decide(spark, cases)] == [0, 2, 0]


def test_equal_spans_of_several_rules_all_count(spark):
    usage = [("P1", "can carry", "used"), ("P2", "used", None), ("P3", "claimed", "used")]
    sentence = ("They used the F-16 aircraft.", "F-16", "W05")
    assert [_decide(spark, [sentence], some)[0][0] for some in (usage, usage[:1], usage[2:])] == [0, 1, 2]


def test_longer_hits_hide_those_inside(spark):
    usage = [("P1", "used", None), ("P2", "can be used", None)]
    assert _decide(spark, [("The F-16 aircraft can be used.", "F-16", "W05"), ("The F-16 aircraft used can be used.", "F-16", "W05")], usage) == [(1, "rule_classification"), (0, "rule_classification")]


def test_the_word_no_is_a_pattern(spark):
    cases = [("There was no F-16 aircraft.", "F-16", "W05"), ("Nobody saw the F-16 aircraft.", "F-16", "W05")]
    assert _decide(spark, cases, [("P1", "no", None)]) == [(2, "rule_classification"), (None, "no_usage_pattern")]


def test_a_target_anywhere_in_the_sentence(spark):
    cases = [("They used the F-16 aircraft and a truck was destroyed.", "F-16", "W05"), ("They used the F-16 aircraft; a truck was destroyed.", "F-16", "W05")]
    assert _decide(spark, cases) == [(2, "weapon_as_target_does_not_establish_its_use")] * 2


def test_forms_that_are_no_use_skip_the_checks(spark):
    cases = [("Possibly the F-16 aircraft can be used.", "F-16", "W05"), ("They will not say it crashed, the F-16 aircraft.", "F-16", "W05")]
    assert [c for c, _ in _decide(spark, cases, [("P1", "can be used", None), ("P2", "crashed", None)])] == [1, 2]


def test_hyphenated_names_are_single_words(spark):
    cases = [("The Ti-reon radar was used.", "Ti-reon", "W02"), ("The TI-REON radar was used.", "TI-REON", "W02")]
    assert [r for _, r in _decide(spark, cases)] == ["single_word_weapon_name_requires_review", "rule_classification"]


def test_a_sentence_of_title_and_body_is_of_the_title(spark):
    pages = spark.createDataFrame([("u", "An F-16 flew.", "One more. An F-16 flew.\n\nOne more. Last.")], "url string, title string, body string")
    got = sorted((r["sentence_no"], r["section"], r["sentence"]) for r in matching.sentences(pages).collect())
    assert got == [(0, "title", "An F-16 flew."), (1, "body", "One more."), (4, "body", "Last.")]


def test_duplicates_whatever_their_dates(spark):
    from corvane.operators import articles

    url = "https://a.example/x"
    inputs = [(1, "a1", "c1", "2024-01-01", url, "t"), (2, "a2", "c1", "2024-05-01", url + "#part", "t"), (3, "a3", "c2", "2024-01-01", url, "t"), (4, "a4", "c1", "2024-01-01", url, "other"), (5, "a5", "c1", "2024-01-01", "https://a.example/y", "t")]
    rows = spark.createDataFrame(inputs, "row_no long, article_id string, conflict_id string, published_date string, url string, title string")
    pages = spark.createDataFrame([(u, None, "extracted") for u in {x[4] for x in inputs}], "url string, title string, status string")
    matches = spark.createDataFrame([(u, "W05", "F-16", "s") for u in {x[4] for x in inputs}], "url string, category_id string, matched_name string, sentence string")
    judged = articles.judged(rows, pages, matches)
    assert [tuple(r) for r in articles.exclusions(judged).collect()] == [(2, "a2", "same_normalized_url_conflict_title_matching_content", "a1")]
    other = matches.withColumn("sentence", matches["url"])  # other content: both stay
    assert articles.exclusions(articles.judged(rows, pages, other)).isEmpty()


def test_articles_of_one_address_and_articles_without_results(spark):
    from corvane.operators import results

    matches = spark.createDataFrame([(1, "u", "W05", "s", 0), (2, "v", "W05", "s", 0)], "match_id long, url string, category_id string, sentence string, sentence_no int")
    decisions = spark.createDataFrame([(1, 0), (2, None)], "match_id long, usage_code int")
    selected = spark.createDataFrame([(1, "a1", "u"), (2, "a2", "u"), (3, "a3", "v")], "row_no long, article_id string, url string")
    got = results.in_result_order(results.results(selected, results.grouped(matches, decisions)))
    assert [tuple(r) for r in got.collect()] == [("a1", "W05", 0, "s"), ("a2", "W05", 0, "s")]


def test_candidates_in_one_pass_equal_the_two_rollups(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice("cd"), rng.choice("uvw"), rng.choice("st"), rng.randint(0, 9), 20200101 + rng.randint(0, 3), rng.choice(["18", "19", "20"]), rng.randint(0, 9), rng.choice(["", None, "x"]), rng.choice([None, "G1", "G2"]), "p", 1, rng.choice([None, 1.0, 2.0]), 0.5, 20200101000000 + rng.randint(0, 9)) for _ in range(300)]
    raw = spark.createDataFrame(rows, "candidate_conflict_id string, source_url string, source_name string, GLOBALEVENTID long, SQLDATE int, EventRootCode string, extraction_confidence int, translation_info string, ActionGeo_CountryCode string, ActionGeo_FullName string, ActionGeo_Type int, ActionGeo_Lat double, ActionGeo_Long double, gdelt_mention_time long")
    want = candidates.url_summary(raw).join(candidates.top_locations(candidates.location_counts(raw)), candidates.KEY)
    got = candidates.candidate_urls(raw)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 0 and plan.count("Join") == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=40))
def test_fingerprints_of_many_equal_those_of_each(strings):
    from corvane.functions.fingerprint import fingerprints64

    assert fingerprints64(strings).tolist() == [fingerprint64(x) for x in strings]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    """The stages that need no network, on a work folder given as an address of a file system."""
    from corvane import __main__

    _work(tmp_path, spark)
    config = json.loads((tmp_path / "config.json").read_text()) | {"work_dir": f"file://{tmp_path}/elsewhere", "buckets": 2}
    (tmp_path / "config.json").write_text(json.dumps(config))
    run = lambda *args: __main__.main([*args, "--config", str(tmp_path / "config.json")])
    with pytest.raises(InputError, match="match needs prepare"):
        run("match")
    run("prepare")
    assert json.loads(capsys.readouterr().out)["rows"] == 7
    with pytest.raises(SystemExit):
        run("collect")
    run("status")
    assert json.loads(capsys.readouterr().out) == {"done": ["prepare"], "pages": {"pending": 5, "invalid_url": 1}}


def test_titles_as_their_sql_has_them(spark, tmp_path):
    import duckdb

    pages = [
        "<title>a &quot;b&amp</title><p>text</p>", "<TITLE lang='x'\n>\u3000\xa0&lt;x&gt; &amp;lt; &#65;\n b\t \u2003</TITLE>", "<title>only a title</title>", "no title", "",
        "<title>cut <b>off</b></title> <title>second</title>", "<!-- <title>hidden</title> --><title>shown</title>", None, "<title>a  b &amp;amp; c $1 \\\\ </title>", "<title", "<title></title>",
    ]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    got = {tuple(r) for r in registry.QUERIES["html_title_extract"](spark, str(tmp_path)).collect()}
    assert got == set(con.execute(registry.ORACLES["html_title_extract"]).fetchall()) and len(got) == len(pages)


def _in_small_batches(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_sentences_are_cut_few_texts_at_a_time(spark, tmp_path):
    spark.createDataFrame([(1, "One is here. Two is there.\n\nThree."), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["sentence_segment"](spark, str(tmp_path))
    assert _in_small_batches(got)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, "One is here."), (1, 2, "Two is there."), (1, 3, "Three.")]


def test_pages_are_read_few_at_a_time(spark, tmp_path):
    spark.createDataFrame([(1, "<title>a &amp; b</title><p>Some text.</p>"), (2, None), (3, "<title>x</title>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.QUERIES["html_text_extract"](spark, str(tmp_path))
    assert _in_small_batches(got)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a & b", 10), (2, None, None), (3, None, None)]


def test_phrases_are_dealt_out_before_equal_ones_are_sought(spark, tmp_path):
    rows = [(i, f"name {i % 7}", "B#1", "T Type", 1, 1.0) for i in range(60)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    for name in ("pattern_expand", "pattern_label"):
        got = registry.QUERIES[name](spark, str(tmp_path))
        plan = got._jdf.queryExecution().sparkPlan().toString().splitlines()
        last = next(i for i, line in enumerate(plan) if "Exchange" in line or "Repartition" in line)
        kinds = [line for line in plan[last:] if "Aggregate" in line]
        assert not kinds and sum("Exchange" in line or "Repartition" in line for line in plan) == 2  # none is made over a file's phrases
        rows = [tuple(r)[:2] for r in got.collect()]
        assert len(rows) == len(set(rows)) > 100
    usage = spark.createDataFrame([("P1", "used", "Use / used")] * 3, "pattern_id string, base_form string, trans_form string")
    assert sorted(r["phrase"] for r in rules.patterns(usage).collect()) == ["use", "use / used", "used", "used"]
