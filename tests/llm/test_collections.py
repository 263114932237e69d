"""Near-duplicates, neighbours, media, pages, archives and the pipeline against brute force and round trips."""

import gzip
import hashlib
import html as entities
import io
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cindermill.llm import ann, html_template, jaccard, media, queries, simhash, warc

SF = "/root/testdata/sf0.01"


def naive_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(fps, distance=2):
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if bin(fps[a] ^ fps[b]).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_simhash(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400).select("doc_id", "text")
    odd = spark.createDataFrame([(9000, None), (9001, ""), (9002, " \n"), (9003, "One"), (9004, "one"), (9005, "İ ß É a b"), (9006, "w " * 50_000)], "doc_id long, text string")
    docs = docs.unionByName(odd).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(0))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fps = {k: naive_fingerprint(t) for k, t in texts.items()}
    want = naive_components(fps)
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {k: (f"{fps[k]:016x}", want[k]) for k in texts}
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == set(want.values())
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_dense_fingerprints_lose_no_link(spark):
    rng = np.random.default_rng(5)
    base, fps = 0x0123456789ABCDEF, {}
    for i in range(300):
        x = base if i < 200 else int(rng.integers(0, 2 ** 63))
        for bit in rng.integers(0, 64, rng.integers(0, 4)):
            x ^= 1 << int(bit)
        fps[i] = x
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in fps.values()]
    pairs = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame(signed, "fp long")).collect()}
    values = sorted({s[0] for s in signed})
    near = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 2}
    assert pairs == near
    # with crowded postings, all or some of them, the same links come from look-ups
    for crowd in (2, 12):
        frame = spark.createDataFrame(signed, "fp long")
        assert simhash.meetings(simhash.postings(frame, 4), 15, crowd)[1].count() > 0
        found = [(r["a"], r["b"]) for r in simhash.links(frame, crowd=crowd).collect()]
        assert set(found) == near and len(found) == len(near)


def test_the_tally_removes_pairs(spark):
    base = 0x1122334455667788
    fps = spark.createDataFrame([(base,), (base ^ 1,), (base ^ 0x10101,), (base ^ 0x0101010100000000,)], "fp long")
    index = simhash.postings(fps, 4)
    met = {(r["a"], r["b"]) for r in simhash.meetings(index, 1)[0].collect()}
    kept = {(r["a"], r["b"]) for r in simhash.meetings(index, 15)[0].collect()}
    # five shared bytes meet in 5 of the 70 kinds, seven in 35: only the latter reach the 15 of six
    assert {(base, base ^ 1), (base, base ^ 0x10101)} <= met and kept == {(base, base ^ 1), (base ^ 1, base ^ 0x10101)}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert simhash.components(edges.where("false")).count() == 0


def test_repeated_ids_stay_once(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.keep_one(docs).collect()] == [1]


def test_near_copies_of_similarity_are_caught(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    rows, similar = [], {}
    for i in range(60):
        first = [words[k] for k in rng.integers(0, 3000, 300)]
        second = list(first)
        for at in rng.integers(0, 300, 1 + i % 8):
            second[at] = "changed"
        rows += [(2 * i, " ".join(first)), (2 * i + 1, " ".join(second))]
        a, b = ({tuple(w[k:k + 5]) for k in range(296)} for w in (first, second))
        similar[2 * i] = len(a & b) / len(a | b) >= 0.8
    got = {r["doc_id"] for r in corpus_pipeline.distinct(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()}
    assert got == {k for k, _ in rows if k % 2 == 0 or not similar[k - 1]}
    crowd = spark.createDataFrame([(i, " ".join(["same"] * 3 + [str(x) for x in range(200)] + [f"end{i}"])) for i in range(300)] + [(900, "alone")], "doc_id long, text string")
    assert {r["doc_id"] for r in jaccard.keep_one(crowd).collect()} == {0, 900}


def test_null_and_clashing_ids_keep_their_texts(spark):
    rows = [(None, "only here"), (None, "b c d"), (1, "a text"), (1, "another text"), (2, "b c d"), (2, "b c d"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for keep in (simhash.keep_one, jaccard.keep_one):
        got = [(r["doc_id"], r["text"]) for r in keep(docs).collect()]
        assert sorted(got, key=str) == sorted([(None, "only here"), (1, "a text"), (1, "another text"), (2, "b c d"), (None, None)], key=str)


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    points = rng.standard_normal((1500, 24))
    rows = [(i, [float(x) for x in v], "x", 0.5) for i, v in enumerate(points)] + [(5000 + i, [float(x) for x in points[0]], "x", 0.5) for i in range(30)]
    bad = [(9000, None, "x", 0.5), (9100, [0.0] * 24, "x", 0.5), (9200, [float("nan")] * 24, "x", 0.5), (9300, [None] + [1.0] * 23, "x", 0.5), (9400, [1.0], "x", 0.5), (9500, [float("inf")] * 24, "x", 0.5)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, id string, score double")
    got = ann.nearest(df, "vec_id", "embedding", lambda i: i % 100 == 0, shard_rows=400).toPandas()
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    found = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((v - v[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = np.lexsort((ids, d))[:10]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and np.allclose(mine["score"], [d[ids == x][0] for x in mine["vec_id"]], rtol=0, atol=0)
        found, total = found + len(set(ids[best]) & set(mine["vec_id"])), total + 10
    assert found / total >= 0.9 and set(got.query_id) == set(ids[ids % 100 == 0])
    copies = got[got.query_id == 0].sort_values("rank")
    assert copies["vec_id"].tolist() == list(range(5000, 5010)) and (copies["score"] == 0).all()
    assert ann.nearest(df.where("vec_id >= 9000"), "vec_id", "embedding", lambda i: i % 100 == 0).count() == 0
    few = ann.nearest(df.where("vec_id in (0, 1, 2)"), "vec_id", "embedding", lambda i: i % 100 == 0).orderBy("rank").collect()
    assert [r["rank"] for r in few] == [1, 2]


def test_a_repeated_query_id_asks_with_its_smallest_vector(spark):
    rows = [(0, [5.0, 5.0]), (0, [1.0, 9.0]), (0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [5.0, 5.1])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", lambda i: i == 0).orderBy("rank").collect()
    assert [(r["vec_id"], round(r["score"], 6)) for r in got] == [(1, 0.5), (2, round((4 ** 2 + 3.1 ** 2) ** 0.5, 6))]


def test_radius_search_is_complete():
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((2000, 32))
    hasher = ann.fit(vectors)
    hasher.radius = 21
    codes = hasher.codes(vectors)
    index = ann.MultiIndex(hasher, codes)
    for q in range(0, 2000, 97):
        assert index.within(codes[q]).tolist() == np.flatnonzero(ann.hamming(codes, codes[q]) <= 21).tolist()


def test_image_formats():
    rng = np.random.default_rng(0)
    grey = rng.integers(0, 256, (11, 7), dtype=np.uint8)
    assert (media.decode_image(media.encode_pgm(grey)) == grey).all() and (media.decode_image(media.encode_bmp(grey)) == grey).all()
    assert (media.decode_image(b"P2 # note\n2 2\n255\n1 2\n3 4") == [[1, 2], [3, 4]]).all()
    assert (media.decode_image(b"P1\n3 1\n101") == [[0, 1, 0]]).all() and (media.decode_image(b"P4\n3 1\n\xa0") == [[0, 1, 0]]).all()
    colour = rng.integers(0, 256, (2, 3, 3), dtype=np.uint8)
    assert (media.decode_image(b"P6\n3 2\n255\n" + colour.tobytes()) == colour).all()
    assert media.decode_image(b"P5\n1 1\n1000\n\x01\x02")[0, 0] == 258


def test_area_resize_is_the_exact_mean():
    image = np.random.default_rng(1).integers(0, 256, (10, 14), dtype=np.uint8)
    fine = np.repeat(np.repeat(image, 4, 0), 6, 1).astype(float)
    assert np.allclose(media.area_resize(image, 8, 12), fine.reshape(8, 5, 12, 7).mean(axis=(1, 3)))
    assert np.allclose(media.area_resize(np.full((1, 64), 7, np.uint8), 8, 9), 7)


def test_media_columns(spark):
    odd = [None, "", "a", "é" * 100, "x" * 64, "long " * 40_000, "a"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(odd)], "doc_id long, text string, media int")
    got = {r["doc_id"]: r for r in media.media_columns(docs).collect()}
    for i, text in enumerate(odd):
        data = (text or "").encode()
        payload = data.ljust(max(1, -(-len(data) // 64)) * 64, b"\0")
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        stored = media.encode_pgm(np.frombuffer(payload, np.uint8).reshape(-1, 64))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest()) and len(r["feature"]) == 16
        assert np.load(io.BytesIO(r["npy_tile"])).shape == (16, 16)
    assert {k: v for k, v in got[2].asDict().items() if k != "doc_id"} == {k: v for k, v in got[6].asDict().items() if k != "doc_id"}
    assert media.media_columns(docs.where("false")).count() == 0


def test_headers_that_promise_too_much_are_no_images(spark):
    huge = [b"P5\n99999999999999999999 99999999999\n255\n", b"P5\n0 5\n255\n", b"P2\n9 9\n255\n1", b"BM" + b"\xff" * 60, b"P5", b"P3\n1 1\n255\nx y z"]
    df = spark.createDataFrame([(f"k{i}", bytearray(b)) for i, b in enumerate(huge)], "key string, media binary")
    got = media.tiles(df, "key", "media").collect()
    assert sorted(r["key"] for r in got) == [f"k{i}" for i in range(len(huge))] and all(r["npy"] is None for r in got)


def test_tiles(spark):
    image = np.arange(64 * 64, dtype=np.uint16).reshape(64, 64).astype(np.uint8)
    df = spark.createDataFrame([(1, bytearray(media.encode_bmp(image))), (2, bytearray(b"junk")), (3, None)], "k long, m binary")
    got = media.tiles(df, "k", "m").collect()
    whole = np.block([[np.load(io.BytesIO(next(r["npy"] for r in got if (r["k"], r["tile_row"], r["tile_column"]) == (1, y, x)))) for x in (0, 1)] for y in (0, 1)])
    assert (whole == image).all() and sum(r["npy"] is None for r in got) == 2


LAYOUT = "<html><head><title>{t}</title></head><body><header><a href=/>Site</a></header><div id=menu><ul><li><a href=/a>{n}</a></li></ul></div><div class=story><h2>{t}</h2>{body}</div><div class='comments'><p>great {t}</p></div><div class=foot>All rights of {n}</div></body></html>"


def test_template_without_article_element(spark):
    words = "alpha beta gamma delta epsilon zeta".split()
    rows = [(i, "http://h.example/x", LAYOUT.format(t=f"T{i}", n=words[i % 6], body="".join(f"<p>{w} {i} &amp; more</p>" for w in words[:2 + i % 4]))) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        assert got[i] == "\n".join([f"T{i}", *(f"{w} {i} & more" for w in words[:2 + i % 4])])


def texts_of(spark, rows):
    return {r["page_id"]: r["text"] for r in html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_layouts_without_marks_on_one_dominant_host(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    body = lambda i: "".join(f"<p>{words[(i + k) % 8]} {i} text of page {k}</p>" for k in range(3 + i % 4))
    story = lambda i: "\n".join(f"{words[(i + k) % 8]} {i} text of page {k}" for k in range(3 + i % 4))
    layouts = [
        lambda i: f"<html><body><div><a href=/>Home</a> <a href=/x>More</a></div><table><tr><td>{body(i)}</td></tr></table><div>All rights kept by the owners of this site, which sells no data to anyone at all, ever.</div></body></html>",
        lambda i: f"<html><body><section><div>{body(i)}</div><div>Our notice is the same on every page of this kind and a good deal longer than eighty characters.</div></section></body></html>",
        lambda i: f"<html><body><div><div><ul><li><a href=/>a</a></li></ul></div><div>{body(i)}<div>Share this page</div></div></div><footer>end</footer></body></html>",
    ]
    rows = [(i, "http://big.example/p", layouts[i % 3](i)) for i in range(45)] + [(100 + i, f"http://small{i}.example/p", layouts[i % 3](i)) for i in range(3)]
    got = texts_of(spark, rows)
    for i in range(45):
        assert got[i] == story(i), i
    assert all(story(i) in got[100 + i] for i in range(3))  # a single page has no template to take away


def test_misleading_class_names_lose_no_article(spark):
    rows = [
        (1, "http://a.example/", "<article class='promo story'><p>Body text</p></article>"),
        (2, "http://b.example/", "<article class=widget><p>Body text</p></article>"),
        (3, "http://c.example/", "<div class='content has-sidebar'><p>Body text</p></div><div class=sidebar>Side</div>"),
        (4, "http://d.example/", "<div id='banner page'><main><p>Body text</p></main></div>"),
        (5, "http://e.example/", "<div class='share box'><p>Body text, and this is long</p></div><div class=ad>Buy</div>"),
        (6, "http://f.example/", "<article><p>Body text</p><div class=comments><p>I am a long comment, longer than the text</p></div></article>"),
    ]
    got = texts_of(spark, rows)
    assert got == {1: "Body text", 2: "Body text", 3: "Body text", 4: "Body text", 5: "Body text, and this is long", 6: "Body text"}


def test_copies_and_long_pages_keep_their_text(spark):
    long = "".join(f"<p>paragraph {k} with words</p>" for k in range(20_000))
    rows = [(i, "http://h.example/", "<html><body><nav>menu</nav><article><p>One and the same</p></article></body></html>") for i in range(6)] + [(9, "http://l.example/", f"<html><body><div class=story>{long}</div></body></html>")]
    got = texts_of(spark, rows)
    assert all(got[i] == "One and the same" for i in range(6)) and got[9].count("\n") == 19_999


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in html_template.main_text(pages).collect()}
    for page in pages.collect():
        article = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article))
        assert got[page["page_id"]]["text"] == "\n".join(b for b in blocks if b)
        assert got[page["page_id"]]["n_chars"] == len(got[page["page_id"]]["text"])


def test_odd_pages(spark):
    rows = [(1, None, None, "a"), (2, "http://a/", "", "a"), (3, "http://a/", "just text &lt;b", "a"), (4, "nonsense", "<p>one<p>two<script>var x='</p>'</script>", "a"), (5, "http://b/", "<article><p>cut off <b", "a"), (5, "http://b/", "<article><p>cut off <b", "a")]
    got = [(r["page_id"], r["text"]) for r in html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()]
    assert sorted(got) == [(1, ""), (2, ""), (3, "just text <b"), (4, "one\ntwo"), (5, "cut off"), (5, "cut off")]
    assert html_template.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archive_round_trip(spark):
    bodies = [None, "", "é" * 30_000, "a", "a", "b" * 5000, "WARC/1.1\r\nfake: 1\r\n\r\n", "a"]
    rows = [(i, None if i % 2 else f"http://x/{i}\r\ny", b, "z") for i, b in enumerate(bodies)]
    got = {r["page_id"]: r for r in warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string, block string"), segment=1000).collect()}
    assert len(got) == len(bodies)
    for i, body in enumerate(bodies):
        data = (body or "").encode()
        first = next(k for k, b in enumerate(bodies) if (b or "") == (body or ""))
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["verified"]) == (len(data), warc.payload_digest(data), "response" if first == i else "revisit", None if first == i else first, True)
    repeated = spark.createDataFrame([(1, "u", "q" * 3000), (1, "u", "q" * 3000), (None, "u", "q" * 3000)], "page_id long, url string, html string")
    assert sorted((str(r["page_id"]), r["record_type"]) for r in warc.archive(repeated, segment=1000).collect()) == [("1", "response"), ("1", "response"), ("None", "revisit")]
    assert warc.archive(repeated.where("false")).count() == 0


def test_long_pages_with_null_or_clashing_ids_stay_apart(spark):
    rows = [(None, "u", "p" * 3000), (None, "u", "q" * 3500), (None, "u", "q" * 3500), (5, "u", "r" * 4000), (5, "u", "s" * 4500), (6, "u", "s" * 4500)]
    got = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string"), segment=1000).collect()
    want = [(i, len(h), warc.payload_digest(h.encode()), "revisit" if i == 6 else "response", 5 if i == 6 else None, True) for i, _, h in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_damaged_segments_are_reported(spark, tmp_path):
    records = list(warc.page_records(7, "u", b"payload " * 500, 7, 1000))
    with gzip.open(tmp_path / "part.gz", "wb") as out:
        out.write(b"".join(r for k, r in enumerate(records) if k != 1))
    row = warc.read_archive(spark, str(tmp_path)).first()
    assert row["verified"] is False and row["payload_bytes"] is None


def test_revisits_are_verified_against_their_response(spark, tmp_path):
    good, altered = (list(warc.page_records(7, "u", p, 7, 10 ** 6))[0] for p in (b"payload", b"PAYLOAD"))
    digest = warc.payload_digest(b"payload").encode()
    for name, response in (("good", good), ("altered", altered.replace(warc.payload_digest(b"PAYLOAD").encode(), digest)), ("missing", b"")):
        (tmp_path / name).mkdir()
        with gzip.open(tmp_path / name / "part.gz", "wb") as out:
            out.write(response + b"".join(warc.page_records(8, "u", b"payload", 7, 10 ** 6)))
        row = warc.read_archive(spark, str(tmp_path / name)).where("record_type = 'revisit'").first()
        assert (row["page_id"], row["verified"], row["refers_to"]) == (8, name == "good", None if name == "missing" else 7)


def test_lines_are_a_stream():
    data = b"a\r\n\r\nbody\nmore\n\nlast\n"
    for size in range(1, 12):
        stream, plain = warc.Lines(iter(data[:-1].split(b"\n"))), io.BytesIO(data)
        while got := plain.read(size):
            assert stream.read(size) == got and stream.readline() == plain.readline()


def test_chunked_framing():
    for data in (b"", b"x", b"y" * 10_000):
        assert warc.unchunked(warc.chunked(data, 999)) == data
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nab\r\n0\r\n\r\n")


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, SF))
        assert docs.columns == columns and {r["doc_id"] for r in docs.select("doc_id").collect()} <= before
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3] > 0
    fps = {r["doc_id"]: naive_fingerprint(r["text"]) for r in docs.collect()}
    assert len(set(naive_components(fps).values())) == len(fps)
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed["doc_id"]) == set(fps) and (packed.groupby("sequence_id")["length"].sum() <= 2048).all()


def test_queries_are_registered(spark):
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11))
    assert isinstance(queries.ORACLES, dict) and pd is not None
