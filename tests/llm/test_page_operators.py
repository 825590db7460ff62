"""URL filters and WARC archives."""

import base64
import gzip
import hashlib
import io
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketloom.llm import queries, urls, warc
from ticketloom.llm.queries import URL_RULES
from ticketloom.session import new_work_dir

URLS = [
    None, "", "no scheme", "http://", "http://A.COM", "https://b.com/", "http://WWW.Example.com/en/1?q#f", "http://example.com/en/",
    "http://m.example.com/en", "http://badexample.com/en/x", "http://x.net/es/1", "http://net/fr/", "http://x.net/de/://y", "ftp://ÀB.org?x/y",
]


def slow_rule(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_hosts_paths_rules_and_verdicts(spark):
    many = [f"http://s{i}.good.com/page/{i}" for i in range(80)] + [f"http://s{i}.bad.net/es/casino{i}" for i in range(80)]
    others = ["http://s.bad.org/es/casino5", "http://s.good.org/page/7"]
    rows = [(i, url, "clash") for i, url in enumerate(URLS + many + others)] + [(0, URLS[6], "again"), (None, URLS[7], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    model = urls.fit(pages, URL_RULES)
    got = urls.judge(pages, URL_RULES, model).collect()
    assert len(got) == len(rows)
    by_row = sorted(((r.host, r.path, r.rule) for r in got), key=str)
    assert by_row == sorted((slow_rule(url)[:3] for _, url, _ in rows), key=str)
    for row in got:
        if row.rule is not None:
            assert row.verdict == {r.name: r.verdict for r in URL_RULES}[row.rule] and row.difference is None
        else:
            assert row.verdict == ("allow" if row.difference >= model.cut else "block")
    verdict = {r.page_id: r.verdict for r in got}
    last = len(URLS) + len(many)
    assert (verdict[last], verdict[last + 1]) == ("block", "allow")


def test_urls_without_labels_are_allowed(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    model = urls.fit(pages, URL_RULES)
    assert {r.verdict for r in urls.judge(pages, URL_RULES, model).collect()} == {"allow"}
    assert urls.judge(pages.where("false"), URL_RULES, model).count() == 0


def test_models_count_every_ruled_url_but_those_of_the_cut(spark):
    good = [f"http://s{i % 7}.good.com/page/{i}" for i in range(12_000)] + ["http://late.com/\u00e9t\u00e9"]
    bad = [f"http://s{i % 5}.bad.net/es/casino{i}" for i in range(300)]
    rows = [(i, url) for i, url in enumerate(good + bad + bad[:20])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    model = urls.fit(pages, URL_RULES)
    grams = {r.gram: (r.allow, r.block) for r in model.counts.collect()}
    by_order = [sum(n[0] for gram, n in grams.items() if gram >> 48 == order) for order in range(urls.ORDER + 1)]
    # Each URL has five bytes with fewer than five before them.
    assert by_order[0] - by_order[5] == 5 * (len(good) - 2_000)
    learned = set(bad) - set(held_out(spark, bad, 60))
    assert sum(n[1] for gram, n in grams.items() if gram >> 48 == 5) == sum(len(url) - 5 for url in learned)


def held_out(spark, some, taken):
    own = spark.createDataFrame([(u,) for u in some], "url string").orderBy(F.xxhash64("url"), "url")
    return [r.url for r in own.limit(taken).collect()]


def test_differences_are_those_of_models_in_memory(spark, monkeypatch):
    monkeypatch.setattr(urls, "BLOCK_BYTES", 200)
    good = [f"http://s{i % 7}.good.com/p/{i * i % 97}" for i in range(60)] + ["http://a.com/\u00e9t\u00e9", "x://c.com/"]
    bad = [f"http://s{i % 5}.bad.net/es/casino{i * i % 89}" for i in range(40)]
    others = ["http://s.bad.org/es/casino5", "http://s.good.org/p/7", "\u00e9", "z", "x://q", "h" * 3000] + ["http://hot.org/"] * 70
    pages = spark.createDataFrame([(i, url) for i, url in enumerate(good + bad + others)], "page_id long, url string")
    model = urls.fit(pages.repartition(3), URL_RULES)
    own = []
    for some in (sorted(set(good)), sorted(set(bad))):
        out = held_out(spark, some, -(-len(some) // 5))
        own.append(urls.MarkovModel([u.encode() for u in some if u not in out]))
    got = urls.judge(pages.repartition(3), URL_RULES, model).where("rule is null").collect()
    assert sorted(r.page_id for r in got) == list(range(len(good + bad), len(good + bad + others)))
    for row in got:
        url = others[row.page_id - len(good + bad)].encode()
        expected = (own[0].log_likelihood(url) - own[1].log_likelihood(url)) / len(url)
        assert row.difference == pytest.approx(expected, rel=1e-9, abs=1e-12)


def test_the_cut_is_the_best_of_all_cuts():
    rng = np.random.default_rng(2)
    for size in (1, 2, 700):
        allow, block = rng.normal(0.3, 1, size).round(2), rng.normal(-0.3, 1, 2 * size).round(2)
        every = sorted([*allow, *block])
        good = lambda cut: (allow >= cut).mean() + (block < cut).mean()  # noqa: B023, E731
        want = max(good((a + b) / 2) for a, b in zip(every, every[1:]))
        assert good(urls.best_cut(allow, block)) == pytest.approx(want)


def test_a_cross_fitted_model_counts_and_scores_every_ruled_url(spark, monkeypatch):
    monkeypatch.setattr(urls, "BLOCK_BYTES", 300)
    good = [f"http://s{i % 7}.good.com/page/{i * i % 9973}" for i in range(1300)]
    bad = [f"http://s{i % 5}.bad.net/es/{'page' if i % 3 else 'casino'}{i}" for i in range(40)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad + bad)], "page_id long, url string").repartition(4)
    model = urls.fit(pages, URL_RULES, cut_urls_per_class=None)
    own = {"allow": sorted(set(good)), "block": bad}
    rows = spark.createDataFrame([(v, u) for v in own for u in own[v]], "rule_verdict string, url string")
    sizes = {v: len(some) for v, some in own.items()}
    fold = {r.url: r.fold for r in urls.in_folds(rows.withColumn("hash", F.xxhash64("url")), sizes).collect()}
    assert sorted(Counter(fold[u] for u in bad).values()) == [8] * 5 and set(fold.values()) == {1, 2, 3, 4, 5}
    for column, some in own.items():
        by_order = Counter()
        for row in model.counts.collect():
            by_order[row.gram >> 48] += row[column]
        assert by_order[0] == sum(map(len, some)) and by_order[5] == sum(len(u) - 5 for u in some)
    differences = {v: [] for v in own}
    for left_out in range(1, 6):
        models = [urls.MarkovModel([u.encode() for u in own[v] if fold[u] != left_out]) for v in own]
        for verdict, some in own.items():
            for url in (u.encode() for u in some if fold[u] == left_out):
                differences[verdict].append((models[0].log_likelihood(url) - models[1].log_likelihood(url)) / len(url))
    assert model.cut == pytest.approx(urls.best_cut(*map(np.array, differences.values())), rel=1e-9)


def test_the_cut_of_many_rows_is_that_of_rows_in_memory(spark):
    rng = np.random.default_rng(5)
    for size in (1, 2, 700):
        allow, block = rng.normal(0.3, 1, size).round(2) + 0.0, rng.normal(-0.3, 1, 2 * size).round(2) + 0.0
        rows = [("allow", float(d)) for d in allow] + [("block", float(d)) for d in block]
        scored = spark.createDataFrame(rows, "rule_verdict string, difference double").repartition(4)
        assert urls.best_cut_of(scored, {"allow": size, "block": 2 * size}) == urls.best_cut(allow, block)
    same = spark.createDataFrame([(v, 0.5) for v in ("allow", "block") * 2], "rule_verdict string, difference double")
    assert urls.best_cut_of(same, {"allow": 2, "block": 2}) == 0.5


def test_op5_learns_and_cuts_by_every_ruled_url(spark, tmp_path, monkeypatch):
    own = [f"http://s{i % 7}.good.com/page/{i}" for i in range(60)] + [f"http://s{i % 5}.bad.net/es/casino{i}" for i in range(40)]
    pages = [(i, url) for i, url in enumerate([*own, "http://q.org/casino7"])]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    models, judge = [], urls.judge
    monkeypatch.setattr(urls, "judge", lambda pages, rules, model: models.append(model) or judge(pages, rules, model))
    assert queries.op5_url_filters(spark, str(tmp_path)).count() == len(pages)
    counted = models[0].counts.where("gram >> 48 = 0").agg(F.sum(F.col("allow") + F.col("block"))).first()[0]
    assert counted == sum(map(len, own))


def test_smoothed_chances_sum_to_one():
    model = urls.MarkovModel([b"http://a.com/b", b"http://a.com/c", b"http://a.com/b"] * 3)
    for context in (b"", b"h", b"http:", b"zzz", b"com/"):
        assert sum(model._chance(context, c) for c in range(256)) == pytest.approx(1)


# -- WARC ------------------------------------------------------------------------------


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def page_rows():
    rows = [(i, f"http://a.org/{i}", f"<p>{i % 7} é 日</p>" * 50) for i in range(40)]
    rows += [(50, None, None), (51, "http://x\r\nWARC-Type: bad", ""), (52, "http://é.org/ ", None), (3, "again", "<p>3 é 日</p>" * 50)]
    return rows + [(None, "no id", "<p>2 é 日</p>" * 50), (60, "long", "\r\n\r\nWARC/1.1\r\n" * 200_000)]


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").repartition(3)
    folder = new_work_dir(spark, "warc-test")
    warc.write_archives(warc.with_revisits(pages), folder, date="2024-01-01T00:00:00Z")
    return folder


def test_pages_survive_the_round_trip(spark, archive):
    first = {}
    for page_id, _, html in page_rows():
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    got = warc.read_archives(spark, archive)
    rows = got.withColumns({"page_id": warc.page_id_of("record_id"), "of": warc.page_id_of("refers_to")}).collect()
    assert len(rows) == len(page_rows())
    html_of = {page_id: html for page_id, _, html in page_rows()}
    for row in rows:
        html = html_of[row.page_id] or ""
        assert row.payload_bytes == len(html.encode()) and row.payload_digest == "sha1:" + digest(html)
        if row.page_id == first[html]:
            assert (row.record_type, row.of) == ("response", None) and bytes(row.payload).decode() == html
        else:
            assert (row.record_type, row.of) == ("revisit", first[html]) and row.payload is None


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    rows = warc.with_revisits(pages, min_bytes=1).where("coalesce(html, '') = ''").collect()
    assert rows and all(r.refers_to is None for r in rows)


def test_filters_are_pushed_down_and_right(spark, archive):
    records = warc.read_archives(spark, archive)
    every = records.drop("payload").collect()
    one = records.where("record_type = 'revisit' and record_id in ('<urn:page:8>', '<urn:page:1>')").drop("payload")
    assert [r.record_id for r in one.collect()] == ["<urn:page:8>"]
    starts = records.where("target_uri like 'http://a.org/1%' and refers_to is not null").drop("payload").collect()
    expected = [r for r in every if (r.target_uri or "").startswith("http://a.org/1") and r.refers_to]
    assert sorted(map(str, starts)) == sorted(map(str, expected)) and starts
    without = warc.read_archives(spark, archive, payload=False)
    assert sorted(map(str, without.drop("payload").collect())) == sorted(map(str, every))
    assert without.where("payload is not null").count() == 0


def test_unwanted_payloads_are_stepped_over():
    big = warc.page_record(1, "u", os.urandom(1 << 20), None, "d")
    small = warc.page_record(2, "u", b"x", None, "d")

    class Counted:
        def __init__(self, data):
            self.data, self.at, self.seen = data, 0, 0

        def read(self, size):
            size = min(size, 4096)
            part = self.data[self.at : self.at + size]
            self.at += len(part)
            self.seen += len(part)
            return part

        def tell(self):
            return self.at

        def seek(self, at):
            self.at = at

    file = Counted(warc.gzip_member(big) + warc.gzip_member(small))
    rows = list(warc.read_records(file, lambda row: row["record_id"] == "<urn:page:2>", True))
    assert [r[-1] for r in rows] == [b"x"] and file.seen < 20_000


def test_archives_of_other_writers(spark):
    """Plain records and gzip members without a length; damaged payloads are an error."""
    data = warc.page_record(1, "u", b"one", None, "d") + warc.page_record(2, "u", b"two", 1, "d")
    for file in (data, gzip.compress(data), gzip.compress(data[:400]) + gzip.compress(data[400:])):
        rows = list(warc.read_records(io.BytesIO(file), lambda row: True, True))
        assert [(r[0], r[-1]) for r in rows] == [("response", b"one"), ("revisit", None)]
        rows = list(warc.read_records(io.BytesIO(file), lambda row: row["record_type"] == "revisit", False))
        assert [r[1] for r in rows] == ["<urn:page:2>"]
    damaged = data.replace(b"one", b"ond")
    with pytest.raises(ValueError, match="does not fit its digest"):
        list(warc.read_records(io.BytesIO(damaged), lambda row: True, True, fail_fast=True))
    rows = list(warc.read_records(io.BytesIO(damaged), lambda row: True, True))
    assert [(r[1], "digest" in (r[-2] or ""), r[-1]) for r in rows] == [("<urn:page:1>", True, b"ond"), ("<urn:page:2>", False, None)]
    assert gzip.decompress(warc.gzip_member(data)) == data


def foreign(name, http=b"HTTP/1.1 200 OK", body=b"12345", line=b"\r\n", kind=b"response", length=None, digest=b"", content=b"application/http"):
    """A record as another writer may leave it."""
    block = http + line * 2 + body if http is not None else body
    said = str(len(block)).encode() if length is None else length
    lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + name, b"Content-Type: " + content, b"Content-Length: " + said]
    if digest:
        lines.append(b"WARC-Payload-Digest: " + digest)
    return line.join(lines) + line * 2 + block + line * 2


SHA1 = hashlib.sha1(b"12345")
FOREIGN = {
    # name: (record, payload_bytes, payload, part of the error)
    b"plain": (dict(), 5, b"12345", None),
    b"said twice": (dict(http=b"HTTP/1.1 200 OK\r\nContent-Length: 5, 5"), 5, b"12345", None),
    b"said wrong": (dict(http=b"HTTP/1.1 200 OK\r\nContent-Length: 99"), 5, b"12345", None),
    b"said in words": (dict(http=b"HTTP/1.1 200 OK\r\nContent-Length: five"), 5, b"12345", None),
    b"line feeds": (dict(http=b"HTTP/1.1 200 OK\nContent-Length: 5", line=b"\n"), 5, b"12345", None),
    b"hex": (dict(digest=b"sha1:" + SHA1.hexdigest().encode()), 5, b"12345", None),
    b"lower base32": (dict(digest=b"SHA-1:" + base64.b32encode(SHA1.digest()).lower()), 5, b"12345", None),
    b"sha256": (dict(digest=b"sha256:" + hashlib.sha256(b"12345").hexdigest().encode()), 5, b"12345", None),
    b"other algorithm": (dict(digest=b"blake9:00"), 5, b"12345", None),
    b"wrong hex": (dict(digest=b"sha1:" + b"0" * 40), 5, b"12345", "digest"),
    b"revisit": (dict(kind=b"revisit", http=b"HTTP/1.1 200 OK\r\nContent-Length: 7, 7", body=b""), 7, None, None),
    b"revisit of unknown length": (dict(kind=b"revisit", body=b""), None, None, None),
    b"request": (dict(kind=b"request", http=b"GET / HTTP/1.1", body=b""), 0, b"", None),
    b"no http": (dict(http=None, content=b"text/plain"), 5, b"12345", None),
    b"no blank line": (dict(http=None, body=b"x" * 1500), 0, b"", None),
    b"empty": (dict(http=None, body=b"", content=b"text/plain"), 0, b"", None),
}


@pytest.mark.parametrize("packed", [lambda r: r, gzip.compress, warc.gzip_member], ids=["plain", "gzip", "gzip with lengths"])
def test_records_of_other_writers(packed):
    records = {name: foreign(name, **cells) for name, (cells, *_) in FOREIGN.items()}
    data = b"".join(map(packed, records.values()))
    expected = [(name.decode(), size, payload, part) for name, (_, size, payload, part) in FOREIGN.items()]
    read = lambda *how: list(warc.read_records(io.BytesIO(data), lambda row: True, *how))
    assert [(r[1], r[-3], r[-1], "digest" if r[-2] else None) for r in read(True)] == expected
    assert [(r[1], r[-3], r[-1], r[-2]) for r in read(False)] == [(name, size, None, None) for name, size, _, _ in expected]


@pytest.mark.parametrize("with_payload", [True, False])
def test_damaged_archives(with_payload):
    good, after = foreign(b"good"), foreign(b"after")
    everything = lambda data, wanted=lambda row: True: [
        (r[1], r[-2]) for r in warc.read_records(io.BytesIO(data), wanted, with_payload)
    ]
    for length in (b"five", b"-1", b"", b"5, 6"):
        bad = foreign(b"bad", length=length)
        for packed in (gzip.compress, warc.gzip_member):
            rows = everything(packed(good) + packed(bad) + packed(after))
            assert [r[0] for r in rows] == ["good", "bad", "after"] and "length" in rows[1][1] and rows[0][1] is rows[2][1] is None
        rows = everything(good + bad + after)
        assert [r[0] for r in rows] == ["good", "bad"] and "length" in rows[1][1]
    cut = everything(good + after[:-10])
    assert [r[0] for r in cut] == ["good", "after"] and "ends within" in cut[1][1]
    assert everything(good + after[:20])[1] == (None, "an archive ends within a record's headers")
    assert everything(good + after[:20], lambda row: row["record_id"] == "good") == [("good", None)]
    member = bytearray(gzip.compress(bytes(range(14, 256)) * 12))
    member[30:40] = b"\xff" * 10
    rows = everything(gzip.compress(good) + bytes(member))
    assert rows[0] == ("good", None) and rows[1][1]
    with pytest.raises(ValueError, match="length"):
        list(warc.read_records(io.BytesIO(foreign(b"bad", length=b"x")), lambda row: True, with_payload, fail_fast=True))


def test_archives_are_bounded_and_other_columns_harmless(spark, monkeypatch):
    names = "page_id long, url string, html string, error string, record_type string, digest string, size int, first int, rows int"
    pages = spark.createDataFrame([(i, "u", f"{i} é" * 100, "e", "t", "d", 1, 2, 3) for i in range(30)] + [(None,) * 9] * 2, names)
    marked = warc.with_revisits(pages)
    assert marked.columns == ["page_id", "url", "html", "refers_to"] and marked.count() == 32
    folder = new_work_dir(spark, "warc-test")
    warc.write_archives(marked.withColumn("payload", F.lit("x")), folder)
    assert warc.read_archives(spark, folder, fail_fast=True).where("error is null").count() == 32
    writer = warc.WarcWriter({"path": new_work_dir(spark, "warc-test")})
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    batch = pa.RecordBatch.from_pylist([{"page_id": i, "url": "u", "html": "x", "refers_to": None} for i in range(40)])
    written = writer.write(iter([batch]))
    writer.commit([written, None])
    assert len(written.names) > 5
    assert warc.read_archives(spark, writer.path).select("record_id").distinct().count() == 40
    assert len(writer.write(iter([])).names) == 1


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = new_work_dir(spark, "warc-test")
    warc.write_archives(warc.with_revisits(pages), folder)
    assert warc.read_archives(spark, folder).count() == 0
