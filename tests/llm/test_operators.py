"""Each operator against a brute-force version, and on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import hashlib
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from docloom.llm import byte_bpe, common, decontaminate, embedding_dedup, license_scan, near_dedup, pii, queries, sharding, token_count, warc
from docloom.session import table
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
SHORT = near_dedup.Setting(width=3, percent=85, rows=6, bands=32)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and blank ones, repeated rows and columns of names that operators use."""
    long = "Lorem ipsum dolor sit amet mail bob@example.org 10.0.0.1 or +49 30 1234567. " * 3000
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (5, long), (6, "x" * 70_000), (7, "é<|endoftext|>ß 4111 1111 1111 1111"), (8, "one two")]
    return spark.createDataFrame([(i, t, "s", 1, "g", "h", 0) for i, t in rows], "doc_id long, text string, size string, y int, `group` string, text_hash string, shard int")


def test_registered():
    assert sorted(queries.queries()) == sorted(x for x in queries.queries() if re.fullmatch(r"op\d+_\w+", x)) and len(queries.queries()) == 13


# 1


def test_token_counts(spark, docs, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in queries.op1_token_counts(spark, SF).collect()}
    for i, text in docs:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((text or "").encode()), n > 512)
    rows = token_count.token_counts(odd, public_tokenizers.path("byte_bpe_50k.json"), chunk=1000, overlap=64).collect()
    want = sorted(len(t.encode(r["text"] or "", add_special_tokens=False).ids) for r in odd.collect())
    assert sorted(r["n_tokens"] for r in rows) == want
    assert token_count.token_counts(odd.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_overlap_widens():
    counter = token_count.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    widened = []
    text = "word " * 100 + "é" * 900 + " tail " * 50
    assert "".join(x for part in token_count.chunks_of(text, 200, 64, widened) for x in part) == text
    assert token_count.count_chunked(counter, text, 200, 64) == len(counter.tokenizer.encode(text).ids)
    assert len(widened) == 1


def test_boundaries_are_proven():
    counter = token_count.Counter(public_tokenizers.path("byte_bpe_50k.json"), 128, 64, cache_bytes=20_000)
    rng = np.random.default_rng(8)
    for alphabet in ("aé中文。， \n'sdt!?019\t\r", "a \xa0\u3000\n.\x1c\x0b\x85\u180e'", "ab' \n中。あ，가"):
        ts = ["".join(rng.choice(list(alphabet), n)) + "<|endoftext|>" * (n % 3) for n in rng.integers(0, 700, 400)]
        assert counter.counts(ts) == [len(counter.tokenizer.encode(t, add_special_tokens=False).ids) for t in ts]
    assert counter.cached <= 20_000


# 2


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, docs, odd, library):
    def want(text):
        ids = library.encode_ordinary(text or "")
        return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op2_byte_bpe(spark, SF).collect()}
    assert got == {i: want(t) for i, t in docs}
    rows = byte_bpe.encode_decode(odd, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True).collect()
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == sorted(want(r["text"]) for r in odd.collect())


def test_bpe_long_matches(library):
    codec = byte_bpe.Codec(byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    rng = np.random.default_rng(3)
    for alphabet in ("ab", "aeinrst", "é中x", "a"):
        text = "".join(rng.choice(list(alphabet), 4000))
        assert codec.encode(text) == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()
    assert list(codec.encode_blocks("one two three " * 50, piece=20))


def test_bpe_batches(library):
    codec = byte_bpe.Codec(byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, cache_bytes=100_000)
    rng = np.random.default_rng(5)
    for alphabet in ("ab", "aeinrst ", "é中x \n", "a", "the and ing'sß"):
        ts = ["".join(rng.choice(list(alphabet), n)) for n in rng.integers(0, 60, 3000)]
        got = [np.frombuffer(x, "<u4").tolist() for x in codec.encode_all(ts)]
        assert got == [library.encode_ordinary(t) for t in ts]
        assert codec.cached <= 100_000 and codec.cached == sum(byte_bpe.ENTRY_BYTES + len(k) + len(v) for k, v in codec.cache.items())


# 3

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(text, items):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    hit, ids = set(), set()
    for item, body in items:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in body or ""))
        for k in range(max(1, len(w) - 9)) if w else ():
            win = w[k : k + 10]
            for i in range(len(words) - len(win) + 1):
                if words[i] == win[0] and words[i : i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    ids.add(str(item))
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def test_decontamination(spark, docs):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in queries.op3_decontamination(spark, SF).collect()}
    assert got == {i: brute_hits(t, items) for i, t in docs}
    assert any(x[4] for x in got.values()) and not all(x[4] for x in got.values())


def test_decontamination_odd(spark, odd):
    items = spark.createDataFrame([(1, "A b!"), (2, None), (3, ""), (1, "A b!"), (4, "ipsum dolor sit")], "item_id long, text string")
    for size in (1, 1 << 20):  # several automata or one give the same
        rows = decontaminate.contamination(odd, items, automaton_bytes=size).collect()
        assert sorted((r["doc_id"] or -1, tuple(r["item_ids"])) for r in rows) == sorted(
            (i, x) for i, x in [(1, ()), (2, ()), (3, ()), (4, ("1",)), (4, ("1",)), (-1, ("1",)), (5, ("4",)), (6, ()), (7, ()), (8, ())]
        )
        kept = decontaminate.drop_contaminated(odd, items, automaton_bytes=size)
        assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 6, 7, 8]
    assert {r["n_words"] for r in decontaminate.contamination(odd.limit(0), items).collect()} == set()
    assert decontaminate.contamination(odd, items.limit(0)).filter("size(runs) > 0").count() == 0
    span = decontaminate.contamination(spark.createDataFrame([(1, "É x-A  B.")], "doc_id long, text string"), items).first()["spans"]
    assert [(s["start"], s["end"]) for s in span] == [(4, 8)]


# 4


def test_warc(spark):
    assert compare(spark, SF, queries.op4_warc, queries.oracle_sql()["op4_warc"]) > 0
    rows = [(1, "u", "a" * 2000), (2, None, "a" * 2000), (3, "u\r\nX: y", None), (4, "u", ""), (None, "u", "b" * 1500), (5, "u", "é" * 600), (6, "u", "é" * 600), (6, "u", "é" * 600), (7, "u", "short"), (8, "u", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.round_trip(pages, archive_bytes=1000).collect())
    assert got == [
        (-1, "response", None, 1500), (1, "revisit", 2, 2000), (2, "response", None, 2000), (3, "response", None, 0), (4, "response", None, 0),
        (5, "revisit", 6, 1200), (6, "response", None, 1200), (6, "response", None, 1200), (7, "response", None, 5), (8, "response", None, 5),
    ]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_wide(spark, monkeypatch):
    """Extra columns, a very long page, and digests both above and below the share at which they're broadcast."""
    monkeypatch.setattr(common, "HOT_KEYS", 3)
    rows = [(k, "u", "h" * 3000, 1) for k in range(40)] + [(100 + k, "u", f"{k // 2}" * 1500, 2) for k in range(12)] + [(200, "u", "z" * 3_000_000, 3)]
    pages = spark.createDataFrame([(i, u, h, n, "x", "y") for i, u, h, n in rows], "page_id long, url string, html string, n long, twin string, response string")
    got = {r["page_id"]: r["refers_to"] for r in warc.round_trip(pages).collect()}
    want = {k: 39 for k in range(39)} | {39: None, 200: None} | {100 + k: None if k % 2 else 101 + k for k in range(12)}
    assert got == want


# 5


def test_licenses(spark, odd):
    assert compare(spark, "/root/testdata/sf0.01", queries.op5_license_scan, queries.oracle_sql()["op5_license_scan"]) > 0
    found = queries.op5_license_scan(spark, "/root/testdata/sf0.01").filter("n_licenses > 0").count()
    assert found > 0
    assert license_scan.scan(odd).count() == odd.count()
    assert license_scan.scan(odd.limit(0)).count() == 0
    assert license_scan.scan(odd, license_scan.notices(spark).limit(0)).filter("size(matches) > 0").count() == 0


# 6

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_pii(spark, docs):
    got = {r["doc_id"]: r for r in queries.op6_pii(spark, SF).collect()}
    for i, text in docs:
        want = brute_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in want) for k in BASE]
        assert got[i]["spans"].startswith(joined)


def test_pii_rules():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        text = "".join(rng.choice(list("a1234 5.-+@()0"), rng.integers(0, 60)))
        assert [(k, a, b) for k, v in pii.base_spans(text).items() for a, b in v] == brute_spans(text)


def test_pii_disclosing_terms(spark, odd):
    rows = [(i, f"{w} reach Zoltan Quimby at zq@example.org {w}x now") for i, w in enumerate("alpha beta gamma delta omega".split())]
    rows += [(100 + i, f"reach people at the desk now number {i} of many words") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(df).collect()}
    terms = {rows[0][1][t["start"] : t["end"]] for t in found[0]["terms"]}
    assert {"Zoltan", "Quimby"} <= terms and not {"reach", "now"} & terms
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert "Quimby" not in clean[0] and "zq@" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[150] == rows[55][1]
    out = pii.sanitise(odd)
    assert out.columns == odd.columns and out.count() == odd.count() and pii.sanitise(odd.limit(0)).count() == 0


def test_pii_rare_entities(spark):
    rows = [(1, "please ask Zoltan Quimby at zq@example.org for help"), (2, "please ask Ursula Vandermeer at uv@example.org for help"), (3, "again please mail Ursula Vandermeer at uv@example.org today")]
    rows += [(100 + i, f"please ask people again at today mail desk for help {i}") for i in range(200)]
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id < 100").collect()
    text = dict(rows)
    terms = {r["doc_id"]: {text[r["doc_id"]][t["start"] : t["end"]] for t in r["terms"]} for r in found}
    assert terms == {1: {"Zoltan", "Quimby"}, 2: {"Ursula", "Vandermeer"}, 3: {"Ursula", "Vandermeer"}}


def test_pii_terms_throughout(spark):
    far = "please ask people for help again today " * 40
    rows = [(1, f"ask Kim Li room 4711 or 김철수 at kl@example.org {far} yours Kim Li, 4711 or 김철수, zq"), (2, f"{far} Kim again")]
    rows += [(100 + i, f"{far} {i} at mail or yours room") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r["doc_id"]: [dict(rows)[r["doc_id"]][t["start"] : t["end"]] for t in r["terms"]] for r in pii.personal_data(df).collect() if r["terms"]}
    assert terms == {1: ["Kim", "Li", "4711", "김철수"] * 2}


def test_pii_pairs_equal_plain_counts(spark, docs):
    """Every pair of an entity and a near term against counts of whole documents in a loop."""
    rows = [*docs, (9001, "write to Zoltan Quimby at zq@example.org"), (9002, "Zoltan Quimby again, zq@example.org or 10.1.2.3"), (9003, "Zoltan alone"), (9004, None)]
    n = len(rows)
    held = [(pii.base_spans(t or ""), {w.lower() for w in re.findall(r"[^\W_]+", t or "")}, t or "") for _, t in rows]
    entities = [set(pii._entities(t, f)) for f, _, t in held]
    free = [{w for w, *_ in pii._free(t, pii._masks(f))} for f, _, t in held]
    near = set().union(*(pii.neighbourhoods(t, f) for f, _, t in held))
    z = pii.CONFIDENCE

    def passes(e, w):
        df_e, df_w = sum(e in x for x in entities), sum(w in x for _, x, _ in held)
        k = sum(e in x and w in y for x, y in zip(entities, free, strict=True))
        low = (k / df_w + z * z / (2 * df_w) - z * np.sqrt(k / df_w * (1 - k / df_w) / df_w + z * z / (4 * df_w**2))) / (1 + z * z / df_w)
        return df_e < n and np.log2(low * n / df_e) >= pii.SHARE * np.log2(n / df_e)

    want = sorted((e, w) for e, w in near if passes(e, w))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, _ = pii.disclosing_terms(df, common.materialise(pii.find(df)))
    assert sorted((r["entity"], r["term"]) for r in got.collect()) == want
    assert {("email:zq@example.org", "quimby")} <= set(want) and ("email:zq@example.org", "at") not in want


def test_pii_names_go_and_words_stay(spark, docs):
    """Names planted beside addresses are found, each of them; of the other words there hardly any."""
    texts = {i: t for i, t in docs if t}
    planted = {i: f"Zq{i}x" for i in list(texts)[::4]}
    cut = {i: max(t.rfind(" ", 0, len(t) // 2), 0) for i, t in texts.items()}  # between two words
    rows = [(i, f"{t[: cut[i]]} {planted[i]} c{i}@example.org {t[cut[i] :]}" if i in planted else t) for i, t in texts.items()]
    # the words around become ordinary ones: other documents have them too
    rows += [(100_000 + 10 * i + k, t) for i, t in texts.items() for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, _ = pii.disclosing_terms(df, common.materialise(pii.find(df)))
    pairs = {(r["entity"], r["term"]) for r in got.collect()}
    ours = {(f"email:c{i}@example.org", name.lower()) for i, name in planted.items()}
    near = set().union(*(pii.neighbourhoods(dict(rows)[i], {"email": pii.emails(dict(rows)[i])}) for i in planted))
    others = {x for x in near if x[0].startswith("email:c") and x not in ours}
    assert ours <= pairs and len(others) > 300
    assert len(others & pairs) < 0.05 * len(others)


# 7


def test_quality(spark, odd):
    big = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.op7_quality(spark, big).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    y = [(rows[r["doc_id"]]["score"], r["quality"]) for r in table(spark, big, "labels").collect() if r["doc_id"] in rows and rows[r["doc_id"]]["held_out"]]
    good, bad = [s for s, q in y if q == 1], [s for s, q in y if q == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9, auc
    from docloom.llm import quality

    model = quality.fit(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(odd, model).collect()} == {0.5}
    assert quality.keep_good(odd, model).columns == odd.columns and quality.score(odd.limit(0), model).count() == 0


# 8


def shingle_set(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_near_dedup(spark, docs, odd):
    sets = {i: shingle_set(t) for i, t in docs}
    want = brute_components(sorted(sets), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    rows = queries.op8_near_dedup(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert any(want[i] != i for i in want)
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(odd, SHORT).select("doc_id", "n_shingles", "component_id").collect() if r["doc_id"] not in (5, 7))
    assert [g[:2] for g in got] == [(-1, 2), (1, 0), (2, 0), (3, 0), (4, 2), (4, 2), (6, 1), (8, 1)] and all(c == i for i, _, c in got if i > 0)
    assert near_dedup.near_duplicates(odd.limit(0), SHORT).count() == 0
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns


def test_near_dedup_chains(spark):
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
    rows = []
    for i in range(120):  # each differs from the next by a few words: one long chain
        base[i % 200] = f"n{i}"
        rows.append((1000 - i, " ".join(base)))
    rows += [(2000 + i, rows[0][1]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingle_set(t) for i, t in rows[:120]}
    want = brute_components(sorted(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, SHORT).collect()}
    assert {i: got[i] for i in want} == want and all(got[2000 + i] == want[1000] for i in range(300))


def test_near_dedup_families(spark, monkeypatch):
    """Copies of one base at similarities around and below the threshold, dealt out in blocks."""
    rng = np.random.default_rng(2)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 150)]
    rows = []
    for i in range(500):
        words = list(base)
        for k in rng.choice(150, int(rng.integers(1, 9)), replace=False):
            words[k] = f"v{int(rng.integers(0, 10**6))}"
        rows.append((int(5000 - i), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingle_set(t) for i, t in rows}
    want = brute_components(sorted(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    assert 1 < len(set(want.values())) < 490
    for members in (1024, 60):
        monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", members)
        assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, SHORT).collect()} == want


def test_likelihood():
    """The slope of the likelihood tells on which side of a similarity its greatest value lies."""
    sketcher = near_dedup.Sketcher(SHORT)
    rng = np.random.default_rng(3)
    for shared in (10, 120, 150, 170, 190):
        words = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (sketcher.registers(x)[None] for x in (words[:200], words[200 - shared : 400 - shared]))
        n = np.array([200.0])
        likeliest = near_dedup.estimate(a, b, n, n)[0]
        for at in (0.3, 0.7, 0.75, 0.9):
            if abs(likeliest - at) > 0.02:
                assert near_dedup.reaches((a == b).sum(1), (a > b).sum(1), (a < b).sum(1), n, n, at)[0] == (likeliest > at)


# 9


def test_sharding(spark, docs, odd):
    rows = queries.op9_sharding(spark, "/root/testdata/sf0.01").collect()
    sizes = np.zeros(16, int)
    of = {}
    for r in rows:
        sizes[r["shard"]] += r["size"]
        assert of.setdefault(r["text_crc32"], r["shard"]) == r["shard"]
    for s in range(16):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert sizes.max() - sizes.min() <= 2 * sizes.mean() / 1000
    placed = sharding.shard(odd, 3, bucket_groups=2, fan_in=2, slot_rows=2).collect()
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in odd.collect())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in placed) == want
    for s in range(3):
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(sum(r["shard"] == s for r in placed)))
    assert sharding.shard(odd.limit(0), 3).count() == 0
    every = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ((r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.01", "documents").collect()))
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == every


def test_sharding_one_group(spark):
    df = spark.createDataFrame([(None if k % 3 else 7, "same") for k in range(500)] + [(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    rows = sharding.shard(df, 4, slot_rows=50).collect()
    assert len({r["shard"] for r in rows if r["size"] == 5}) == 1 and len(rows) == 520
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


@pytest.mark.parametrize("hot_keys", [1, 4, 4096])
def test_join_hot(spark, monkeypatch, hot_keys):
    monkeypatch.setattr(common, "HOT_KEYS", hot_keys)
    keys = ["a"] * 50 + ["b"] * 30 + ["c"] * 3 + ["d"] + [None] * 9
    rows = spark.createDataFrame(list(enumerate(keys)), "i long, k string")
    found = spark.createDataFrame([("a", 1, 50), ("b", 2, 30), ("c", 3, 3)], "k string, v int, n long")
    got = common.join_hot(rows, found, "k", "v").collect()
    value = {"a": 1, "b": 2, "c": 3}
    assert sorted((r["i"], r["v"] or 0) for r in got) == [(i, value.get(k, 0)) for i, k in enumerate(keys)]
    assert sorted(got[0].asDict()) == ["i", "k", "v"]
    assert common.join_hot(rows, found.limit(0), "k", "v").filter("v is null").count() == len(keys)


def test_differencing():
    rng = np.random.default_rng(2)
    values = rng.integers(1, 10_000, 500).tolist()
    sums = np.bincount(sharding.partition(values, 7), weights=values, minlength=7)
    assert sums.max() - sums.min() <= 20


# 10


def test_embeddings(spark):
    rows = [r for r in table(spark, SF, "embeddings").collect()]
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in rows}
    label = {r["vec_id"]: r["label"] for r in rows}
    unit = {i: v / np.linalg.norm(v) for i, v in x.items()}
    linked = {(a, b) for a in x for b in x if a != b and label[a] is not None and label[a] == label[b] and float(unit[a] @ unit[b]) >= 0.93}
    want = brute_components(sorted(x), lambda a, b: (a, b) in linked)
    got = {r["vec_id"]: r for r in queries.op10_embedding_dedup(spark, SF).collect()}
    n = sum(r["n_links"] for r in got.values())
    assert n == len(linked)
    assert {i: got[i]["component_id"] for i in want} == want


def test_embeddings_odd(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [1.0, None], 1), (8, [1.0, 0.1], 1), (8, [1.0, 0.1], 1), (9, [], 1), (10, [1.0, 0.0], 2), (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [(-1, 0, None), (1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 3, 1), (8, 3, 1), (9, 0, 9), (10, 0, 10), (11, 0, 11)]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_repeated_ids(spark):
    """Vectors that share an id are classes of their own, with their own links."""
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df.withColumn("id", F.lit(7)).withColumn("key", F.lit("k"))).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_embedding_lists():
    """With hundreds of lists, and vectors of few real dimensions, one of two partners always looks into the other's list."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 8)) @ rng.standard_normal((8, 96))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = embedding_dedup.fit(x, 300)
    own, looks = index.probes(x, float(np.sqrt(0.14)))
    a, b = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
    assert len(a) > 1000 and (own[a] != own[b]).any()
    assert (looks[a, own[b]] | looks[b, own[a]]).all()


def test_embedding_recall(spark):
    """Each vector's links and component against brute force, on a table with links within and across lists."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((200, 48))
    x = np.repeat(centres, 15, axis=0) + 0.22 * rng.standard_normal((3000, 48))
    df = spark.createDataFrame([(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)], "vec_id long, embedding array<float>, label int")
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    linked = (u @ u.T >= 0.93) & (np.arange(3000)[:, None] % 2 == np.arange(3000) % 2)
    np.fill_diagonal(linked, False)
    least = np.arange(3000)
    while True:
        lower = np.minimum(least, np.where(linked, least, 3000).min(1))
        if (lower == least).all():
            break
        least = lower
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df, block=500).collect()}
    assert linked.sum() > 5_000
    assert got == {i: (int(linked[i].sum()), int(least[i])) for i in range(3000)}


def test_embedding_range(spark):
    """Doubles whose squares overflow or vanish link as any others do, in the operator and in its SQL."""
    import duckdb

    rows = [(1, [1e200, 0.0], 1), (2, [3e200, 1e199], 1), (3, [1e-200, 0.0], 1), (4, [5e-324, 0.0], 1), (5, [0.0, 1e308], 1), (6, [-0.0, 1e-310], 1), (7, [float("inf"), 0.0], 1), (8, [0.0, -0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (0, 8)}
    con = duckdb.connect()
    con.execute("create table embeddings (vec_id bigint, embedding double[], label int)")
    con.executemany("insert into embeddings values (?, ?, ?)", rows)
    assert {i: (n, c) for i, n, c, _ in con.execute(queries._OP10).fetchall()} == got


def test_embedding_forest():
    """Sets joined pair by pair are the components of the pairs, each named by its first place."""
    rng = np.random.default_rng(2)
    for n, m in ((1, 0), (50, 30), (400, 300), (400, 2000)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        forest = embedding_dedup._Forest(n)
        for k in range(0, m, 97):
            forest.join(a[k : k + 97], b[k : k + 97])
        pairs = set(zip(a.tolist(), b.tolist(), strict=True))
        want = brute_components(list(range(n)), lambda x, y: (x, y) in pairs or (y, x) in pairs)
        assert forest.root.tolist() == [want[i] for i in range(n)]
    forest = embedding_dedup._Forest(5000)
    forest.join(np.arange(4999), np.arange(1, 5000))
    assert not forest.root.any()


# the pipeline


def test_pipeline(spark, library):
    import corpus_pipeline
    from docloom.llm import quality

    sf = "/root/testdata/sf0.01"
    rows = corpus_pipeline.run(spark, sf).collect()
    docs = table(spark, sf, "documents")
    model = quality.fit(docs, table(spark, sf, "labels"))
    good = {r["doc_id"] for r in quality.score(docs, model).collect() if r["score"] >= 0.5}
    text = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in good}
    sets = {i: shingle_set(t, 5) for i, t in text.items()}
    by: dict = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, set()).add(i)
    near = {(a, b) for i, s in sets.items() for g in s for a, b in [(i, j) for j in by[g]] if a < b}
    linked = {(a, b) for a, b in near if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    of = {i: i for i in text}
    for _ in range(20):
        for a, b in sorted(linked):
            of[a] = of[b] = min(of[a], of[b])
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    windows = [w for item, body in items for w in decontaminate.windows_of(body)]
    padded = {i: f" {' '.join(w.decode() for w in decontaminate.words_of(t or ''))} " for i, t in text.items() if of[i] == i}
    want = {i for i, t in padded.items() if not any(w in t for w in windows)}
    assert {r["doc_id"] for r in rows} == want and len(rows) == len(want)
    for r in rows:
        assert library.encode_ordinary(r["decoded"]) == list(r["ids"]) and not pii.emails(r["decoded"])
        if not brute_spans(text[r["doc_id"]]):
            assert r["decoded"] == (text[r["doc_id"]] or "")


def test_pipeline_odd(spark, tmp_path):
    """Null ids and texts, empty and very long texts, repeated rows, copies, clashing columns, and empty tables."""
    import corpus_pipeline

    item = "the quick brown fox jumps over the lazy dog again today"
    long = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor. " * 3000
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "a b c d"), (4, "a b c d"), (9, "a b c d"), (None, "a b c d"), (5, long), (6, long)]
    rows += [(7, f"so {item} it went"), (8, "ask Zoltan at zq@example.org")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or ""), "h", 1, "k", "s") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, text_hash string, y int, key string, spans string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/odd/{name}.parquet")
        df.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    got = [(r["doc_id"], r["decoded"]) for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()]
    assert sorted(i or -1 for i, _ in got) == [-1, 1, 2, 3, 4, 4, 5, 8]
    text = dict(got)
    assert text[1] == text[2] == "" and text[3] == "  \n\t " and text[4] == text[None] == "a b c d" and text[5] == long
    assert "[EMAIL]" in text[8] and "zq@" not in text[8]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, f"{tmp_path}/odd")
        assert kept.columns == docs.columns
