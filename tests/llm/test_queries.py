"""Every query of the folder beside its SQL, or a brute-force version where it has none."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from brinemark.llm import fingerprints, line_dedup, token_counts
from brinemark.llm.oracle import ORACLE
from brinemark.llm.queries import QUERIES
from tests.compare import difference, duck, rows_of_duck, rows_of_spark


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, con, name):
    assert difference(rows_of_spark(QUERIES[name](spark, sf_dir)), rows_of_duck(con, ORACLE[name])) is None


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, sf_dir, documents):
    fps = {i: simhash(t) for i, t in documents}
    links = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    roots = components(fps, links)
    rows = QUERIES["op7_simhash"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}
    assert len(rows) == len(fps) and links


def grams(line):
    return {line[k:k + 8] for k in range(max(1, len(line) - 7))}


def naive_lines(documents):
    """Kept lines per document, by comparing all pairs of distinct lines."""
    placed = [(i, p, raw.strip(" ").lower()) for i, t in documents for p, raw in enumerate((t or "").split("\n"))]
    placed = [x for x in placed if x[2]]
    distinct = sorted({x[2] for x in placed})
    sets, holders = [grams(x) for x in distinct], defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    links = []
    for k, s in enumerate(sets):
        common = Counter(m for g in s for m in holders[g] if m < k)
        links += [(m, k) for m, c in common.items() if c >= 0.8 * (len(s) + len(sets[m]) - c)]
    roots, seen, kept = components(range(len(distinct)), links), set(), defaultdict(list)
    number = {x: k for k, x in enumerate(distinct)}
    for i, p, line in placed:
        root = roots[number[line]]
        if root not in seen:
            seen.add(root)
            kept[i].append(p)
    return kept


def test_line_dedup_equals_brute_force(spark, sf_dir, documents):
    kept = naive_lines(documents)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    shown = {r["doc_id"]: r for r in QUERIES["op6_line_dedup"](spark, sf_dir).collect()}
    assert len(shown) == len(rows) == len(documents)
    for i, text in documents:
        parts = text.split("\n")
        want = "\n".join(x for p, x in enumerate(parts) if p in kept[i] or not x.strip(" "))
        assert rows[i]["text"] == want
        assert shown[i]["n_lost"] == rows[i]["n_lost"] == sum(p not in kept[i] and x.strip(" ") != "" for p, x in enumerate(parts))
        assert shown[i]["n_chars"] == len(want) and shown[i]["text_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert sum(r["n_lost"] for r in rows.values()) > 0


def test_toxicity_holds_out(spark, sf_dir, con):
    rows = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, sf_dir).collect()}
    assert len(rows) == con.execute("SELECT count(*) FROM documents").fetchall()[0][0]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())


def test_toxicity_ranks_held_out_documents(spark, con):
    big = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r["score"] for r in QUERIES["op3_toxicity"](spark, big).where("held_out").collect()}
    labels = dict(duck(big).execute("SELECT doc_id, toxic FROM labels").fetchall())
    ones = [s for i, s in rows.items() if labels.get(i) == 1]
    zeros = [s for i, s in rows.items() if labels.get(i) == 0]
    assert sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros)) > 0.93


def test_fingerprints_equal_brute_force(spark, sf_dir, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op5_fingerprints"](spark, sf_dir).collect()}
    for k, (i, text) in enumerate(documents):
        after = documents[(k + 1) % len(documents)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]

        def alike(a, b):
            a, b = Counter(fingerprints.paragraphs(a)), Counter(fingerprints.paragraphs(b))
            both, either = sum((a & b).values()), sum((a | b).values())
            return both / either if either else 1.0

        assert rows[i]["n_chars"] == len(text)
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i]["near_edited"] == pytest.approx(alike(text, edited))
        assert rows[i]["near_next"] == pytest.approx(alike(text, after))
    by_text = defaultdict(set)
    for i, text in documents:
        by_text[text].add(rows[i]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())


def test_token_report_equals_brute_force(spark, sf_dir, documents):
    import base64

    import tiktoken

    pattern, ranks = token_counts.vocabulary()
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    encoding = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    lengths = [len(encoding.encode_ordinary(t)) for _, t in documents]
    rows = QUERIES["op10_token_counts"](spark, sf_dir).collect()
    assert {r["n_tokens"] for r in rows} == set(lengths)
    for r in rows:
        n = r["n_tokens"]
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_at_most"] == sum(x <= n for x in lengths) and r["docs_over"] == sum(x > n for x in lengths)
        assert r["tokens_at_most"] == sum(x for x in lengths if x <= n)
        assert r["tokens_truncated"] == sum(min(x, n) for x in lengths) and r["tokens_total"] == sum(lengths)
        assert r["quantile"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
