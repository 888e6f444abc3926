"""Ops 4, 8, 9 and 10: brute force, round trips and edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from measurekit.llm import decontaminate, preference, url_rules, warc
from measurekit.llm.queries import QUERIES, URL_RULES

URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG/en/1", "http://a.example.org/en/2", "http://a.example.org/es/x", "http://notexample.org/es/", "http://org/",
    "http://x.org", "http://x.com/fr/1?u=http://y.org/", "ftp://x.com/de/?a", "http://x.com/DE/", "http://x.com?de/", "http://u@x.com:80/de/a#b", "http://É.Com/fr/é", "a://b://c/d",
]


def expected(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in URL_RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return host, path, best.text if best else None, best.verdict if best else "allow"


def test_stated_rules(spark):
    frame = spark.createDataFrame([(i, u, "old") for i, u in enumerate([*URLS, URLS[4]])], "page_id long, url string, verdict string")
    rows = url_rules.judge(frame, URL_RULES).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows] == [expected(u) for u in [*URLS, URLS[4]]]
    assert url_rules.judge(frame.limit(0), URL_RULES).collect() == []


def low(share, n, z=url_rules.CERTAINTY):
    return (share + z * z / (2 * n) - z * (share * (1 - share) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        host = rng.choice(["spam.example.net", "news.example.net", "shop.other.biz", "blog.other.biz"])
        path = rng.choice(["/casino/", "/article/", "/p/"]) + str(i) + rng.choice(["", ".html", "?ref=1"])
        bad = "casino" in path and rng.random() < 0.9 or host.startswith("spam") and rng.random() < 0.7 or rng.random() < 0.05
        rows.append((i, f"http://{host}{path}", bad))
    frame = spark.createDataFrame([*rows, (1000, None, True), (1001, "http://spam.example.net/x", None)], "page_id long, url string, block boolean")
    mined = url_rules.mine(frame, min_support=0.02, min_urls=5, min_confidence=0.6)
    found = {tuple(r["tokens"]): r["confidence"] for r in mined.collect()}
    tokens = {r["page_id"]: frozenset(r["t"]) for r in frame.select("page_id", url_rules.tokens_of(F.col("url")).alias("t")).collect()}
    labelled = [(tokens[i], bad) for i, _, bad in rows]
    names = sorted(set().union(*(t for t, _ in labelled)))
    base, every = sum(b for _, b in labelled) / len(labelled), {}
    for size in (1, 2):
        for combo in itertools.combinations(names, size):
            hit = [b for t, b in labelled if t.issuperset(combo)]
            if sum(hit) >= 0.02 * len(labelled) and sum(hit) / len(hit) >= 0.6 and sum(hit) / len(hit) / base >= 1:
                every[combo] = sum(hit) / len(hit)
    covered = lambda c: sum(t.issuperset(c) for t, _ in labelled)
    every = {c: v for c, v in every.items() if low(v, covered(c)) > base}
    wanted = {c: v for c, v in every.items() if not any(set(o) < set(c) and every[o] >= v for o in every)}
    assert wanted and {c: v for c, v in found.items() if len(c) <= 2} == pytest.approx(wanted)
    best = {i: max([v for c, v in found.items() if t.issuperset(c)], default=None) for i, t in tokens.items()}
    for join_limit in (50_000, -1):
        url_rules.BROADCAST_RULES, kept = join_limit, url_rules.BROADCAST_RULES
        try:
            judged = url_rules.judge(frame, (), mined).collect()
        finally:
            url_rules.BROADCAST_RULES = kept
        assert len(judged) == 402
        for r in judged:
            assert r["mined_confidence"] == pytest.approx(best[r["page_id"]]) and r["verdict"] == ("block" if best[r["page_id"]] else "allow")


def test_a_label_below_many_parents_is_mined_by_the_query(spark, tmp_path):
    """Through the query's own join of pages and labels: one host label marks bad pages below three parents."""
    rows, labels = [], []
    for i in range(120):
        bad = i % 4 == 0
        host = ("casino-win." if bad else f"site{i % 7}.") + ["example.com", "example.net", "other.info"][i % 3]
        rows.append((i, f"http://{host}/en/{i}"))
        labels.append((i, 0 if bad else 1))
    rows += [(1000, "http://www.casino-win.fourth.net/en/99999"), (1001, "http://site1.fourth.net/en/99999"), (1002, None), (1003, "http://casino-win.x.org/a")]
    spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'' AS html").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["page_id"]: r for r in QUERIES["op4_url_rules"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    assert found[1000]["verdict"] == "block" and found[1000]["rule"] is None and found[1000]["mined_confidence"] == 1.0
    assert found[1001]["verdict"] == found[1002]["verdict"] == "allow" and (found[1002]["host"], found[1002]["path"]) == ("", "")
    assert found[1003]["verdict"] == "allow" and found[1003]["rule"] == "org/" and found[1003]["mined_confidence"] == 1.0
    assert all((found[i]["mined_rule"] is not None) == (i % 4 == 0) for i in range(120))


def test_labels_that_do_not_depend_on_urls_give_no_rules(spark):
    rng = random.Random(5)
    rows = [(f"http://{rng.choice('abcdefgh')}.example.{rng.choice(['com', 'net'])}/{rng.choice(['en', 'de'])}/{i}", rng.random() < 0.45) for i in range(600)]
    assert url_rules.mine(spark.createDataFrame(rows, "url string, block boolean"), min_confidence=0.3).count() <= 2
    assert url_rules.mine(spark.createDataFrame(rows, "url string, block boolean")).count() == 0


def test_mining_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, block boolean")
    assert url_rules.mine(empty).collect() == []


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = []
    for item, text in items:
        words = cut(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.append((str(item) if item is not None else "null", words[i : i + 10]))
    out = []
    for doc, text in docs:
        words, hit, found = cut(text), set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
        out.append((doc, len(words), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [200_000, 3])
def test_windows_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    rng = random.Random(6)
    word = lambda: rng.choice(["the", "of", "and", "straße", "x1", "Été"]) + rng.choice(["", "", "a", "b"])
    items = [(i, " ".join(word() for _ in range(rng.choice([9, 10, 11, 25])))) for i in range(5)] + [(20, "Only"), (21, "two-words"), (22, None), (23, "..!"), (None, "the the the"), (5, "five"), (5, "FIVE six")]
    docs = []
    for i in range(30):
        words = [word() for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            words[5:5] = items[i % 5][1].upper().replace(" ", "; ").split()
        docs.append((i, " ".join(words)))
    docs += [(40, None), (41, ""), (42, "only ONLY"), (43, "x " * 5000 + items[3][1] + " " + items[3][1]), (43, "five six"), (44, "É été")]
    frame = spark.createDataFrame([(i, t, "n") for i, t in docs], "doc_id long, text string, n_words string").repartition(4)
    found = decontaminate.contamination(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found), key=str) == brute(docs, items)


def test_no_items_and_no_documents(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[2:] for r in decontaminate.contamination(docs, items).collect()] == [(2, 0, [], False)]
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "a b")], items.schema)).collect() == []


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    long, short = "lang ü " * 40, "s" * 99
    pages = [(i, f"http://h{i % 3}.example.org/p{i % 4}?q#f", long if i in (3, 5, 9) else short if i in (2, 4) else f"<p>{i}\r\n\r\n</p>") for i in range(12)]
    pages += [(20, None, None), (21, "", ""), (22, "no scheme\r\nInjected: x", "<html>" + "y" * 300_000), (3, "http://again/", long), (None, "http://none/", long)]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, key string").repartition(4)
    folder = warc.write(frame)
    rows = warc.read(spark, folder).collect()
    got = sorted(((r["page_id"], r["url"] or None, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)
    wanted = []
    for page, url, html in pages:
        raw = (html or "").encode()
        revisit = html == long and page != 3
        wanted.append((page, url or None, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(wanted, key=str)
    kept = {r["page_id"]: r["payload"] for r in rows if r["record_type"] == "response"}
    assert bytes(kept[22]).decode() == pages[14][2] and all(r["payload"] is None for r in rows if r["record_type"] == "revisit")
    wanted_urls = spark.createDataFrame([("http://H0.example.org/p0?q",), ("http://absent/",), (None,), ("http://again/",)], "url string")
    found = warc.lookup(spark, folder, wanted_urls).collect()
    same = sorted(p for p, u, _ in pages if u and warc.url_key(u) == warc.url_key("http://h0.example.org/p0?q"))
    assert sorted(r["page_id"] for r in found if "H0" in r["wanted"]) == same and len(same) > 0
    assert [r["page_id"] for r in found if r["wanted"] == "http://again/"] == [3] and not [r for r in found if "absent" in r["wanted"]]


def test_index_finds_keys_that_span_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rows = [(i, "http://hot.example/", f"page {i}") for i in range(30)] + [(100 + i, f"http://a{i}.example/", "a") for i in range(10)]
    folder = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    found = warc.lookup(spark, folder, spark.createDataFrame([("http://hot.example/",), ("http://a3.example/",)], "url string")).collect()
    assert sorted(r["page_id"] for r in found) == [*range(30), 103]


def test_empty_archive(spark):
    folder = warc.write(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read(spark, folder).collect() == []
    assert warc.lookup(spark, folder, spark.createDataFrame([("http://x/",)], "url string")).collect() == []


def show(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def marks(turns):
    at, out = 0, []
    for r, t in turns:
        end = at + len(show([(r, t)]))
        if r == "assistant":
            out.append((at + len("<|assistant|>\n"), end))
        at = end
    return out


CASES = [
    ([("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "b")]),
    ([("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "a")]),
    ([("user", "q")], [("user", "q"), ("assistant", "ü" * 50), ("user", "r"), ("assistant", "")]),
    ([], [("system", "s")]), ([], []), ([(None, None), ("assistant", None)], [(None, None), ("assistant", "x")]), ([("user", "a")], [("system", "a")]), (None, [("user", "x" * 20_000)]),
]


def test_pairs_share_their_longest_prefix(spark):
    rows = [(i, *[None if s is None else [(k, r, t) for k, (r, t) in enumerate(s)] for s in pair], "old") for i, pair in enumerate([*CASES, CASES[0]])]
    kind = "array<struct<turn:long,role:string,text:string>>"
    frame = spark.createDataFrame(rows, f"id long, chosen {kind}, rejected {kind}, prompt string")
    found = preference.format_pairs(frame).orderBy("id").collect()
    for row, (a, b) in zip(found, [*CASES, CASES[0]]):
        a, b = a or [], b or []
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert (row["prompt"], row["n_prompt_turns"]) == (show(a[:n]), n)
        assert (row["chosen_text"], row["rejected_text"]) == (show(a[n:]), show(b[n:]))
        assert [tuple(s) for s in row["chosen_spans"]] == marks(a[n:]) and [tuple(s) for s in row["rejected_spans"]] == marks(b[n:])


def test_conversations_with_foreign_answers(spark):
    turns = [(0, 1, "assistant", "a0"), (0, 0, "user", "q0"), (0, 2, "user", "bye"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (3, 0, "user", "only"), (4, 0, "assistant", "x"), (None, 0, "user", "n")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = {r["conv_id"]: r for r in preference.with_foreign_answers(preference.assemble(frame)).collect()}
    text = lambda i, side: [(t["role"], t["text"]) for t in rows[i][side]]
    assert text(0, "chosen") == [("user", "q0"), ("assistant", "a0"), ("user", "bye")] and text(0, "rejected") == [("user", "q0"), ("assistant", "a1")]
    assert text(1, "rejected") == [("user", "q1"), ("assistant", "a0")] and text(3, "rejected") == text(3, "chosen")
    assert text(4, "rejected") == [] and text(None, "rejected") == [("user", "n")]
    assert preference.assemble(frame.limit(0)).collect() == []


def test_query_searches_the_index(spark, tmp_path, monkeypatch):
    """A directory out of order must be noticed: the query reaches its records by binary search."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    rows = [(i, f"http://h{i:03}.example/", f"page {i}") for i in range(40)] + [(50, None, "x"), (51, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    query = QUERIES["op9_warc"]
    assert sorted(r["page_id"] for r in query(spark, str(tmp_path)).collect()) == [*range(40), 50, 51]
    straight = warc.index_tail

    def wrong(spark_, folder):
        build(spark_, folder)
        manifest = spark_.read.parquet(f"{folder}/manifest").collect()
        system, path = warc.place(manifest[0]["uri"])
        part = warc.IndexPart(manifest[0]["uri"])
        data = b"".join(part._range(at, n) for _, at, n in part.directory)
        turned = warc.zlib.compress(warc.json.dumps(part.directory[::-1]).encode())
        with system.open_output_stream(path, compression=None) as out:
            out.write(data + turned + straight(len(data), len(turned)))

    build = warc.build_index
    monkeypatch.setattr(warc, "build_index", wrong)
    assert len(query(spark, str(tmp_path)).collect()) < 42
