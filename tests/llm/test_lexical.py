"""Byte-level BPE, spelling variants and ranked search against plain versions of them."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventmart.llm import bytebpe, search, variants
from eventmart.llm.queries import op11_byte_bpe


@pytest.fixture(scope="module")
def vocabulary():
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = str(P.path("byte_bpe_multi_50k.tiktoken"))
    return path, P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(path), special_tokens={})


def texts_to_encode() -> list[str | None]:
    rng = random.Random(3)
    texts = [None, "", "a", "a" * 20_001, "haha" * 60, "ab" * 40, "it's  we'll\n\n \t x ", "Ünïcode 中文字 テスト 한국어 العربية 🙂🙃", "<|endoftext|>"]
    texts += ["".join(rng.choices("abcdefghij", k=600)), "x " * 4000, "0123456789" * 9]
    texts += ["".join(rng.choices("aabcehtinorst' .1\n", k=200)) for _ in range(40)]
    # every assigned and unassigned character of the first planes that a class could tell apart
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(c + rng.choice(" a1\n") for c in points[k : k + 400]) for k in range(0, len(points), 400)]
    return texts


def test_bpe_equals_the_library(spark, docs, vocabulary, monkeypatch):
    path, pattern, library = vocabulary
    monkeypatch.setattr(bytebpe, "BLOCK_BYTES", 3000)
    texts = texts_to_encode()
    rows = docs(*texts, (7, "twice"), (None, "nobody"), extra="'x' AS words")
    encoded = bytebpe.encode(rows.repartition(5), path, pattern)
    found = encoded.select("doc_id", "ids", bytebpe.decoder(path)("ids").alias("text"), bytebpe.little_endian("ids").alias("le")).collect()
    assert len(found) == len(texts) + 2
    given = {k: t or "" for k, t in enumerate(texts)} | {None: "nobody"}
    for r in found:
        text = "twice" if r.doc_id == 7 and bytes(r.text) == b"twice" else given[r.doc_id]
        assert bytes(r.text) == text.encode() and r.ids == library.encode_ordinary(text)
        assert bytes(r.le) == b"".join(i.to_bytes(4, "little") for i in r.ids)
    assert bytebpe.encode(docs("x").where("false"), path, pattern).count() == 0


def test_bpe_merges_where_ranks_are_out_of_order(spark):
    """Pieces whose merges make pairs of lower rank: the short and the long way both merge one by one in effect."""
    singles = {bytes([b]): b for b in range(256)}
    ranks = singles | {t: 256 + k for k, t in enumerate([b"abab", b"ba", b"ab", b"aba", b"aa", b"aaaa", b"aaa", b"bab"])}
    rng = random.Random(5)
    words = ["".join(rng.choices("ab", k=n)) for n in (1, 2, 3, 5, 8, 13, 40, 70, 90, 150) for _ in range(12)] + ["a" * 99, "ab" * 50]

    def plain(word: bytes) -> list[int]:
        if word in ranks:
            return [ranks[word]]
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, k = min((ranks.get(x + y, 10**9), k) for k, (x, y) in enumerate(zip(parts, parts[1:])))
            if rank == 10**9:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [ranks[p] for p in parts]

    import base64
    import tempfile

    with tempfile.NamedTemporaryFile("w", suffix=".tiktoken") as file:
        file.write("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in ranks.items()))
        file.flush()
        maps = bytebpe.RankMaps(file.name)
    rows = spark.createDataFrame([(w, list(w.encode())) for w in words], "w string, bytes array<int>")
    for r in rows.select("w", bytebpe.encode_word(F.col("bytes"), maps).alias("ids")).collect():
        assert r.ids == plain(r.w.encode()), r.w


def test_bpe_merges_words_together(spark, docs, vocabulary, monkeypatch):
    """Thousands of distinct words in bounded slices: no expression is interpreted word by word, and no task holds a large block."""
    path, pattern, library = vocabulary
    seen = []
    plain = bytebpe.merge_equal
    monkeypatch.setattr(bytebpe, "MERGED_BYTES", 1000)
    monkeypatch.setattr(bytebpe, "merge_equal", lambda words, maps: (seen.append(words.size), plain(words, maps))[1])
    rng = random.Random(9)
    words = ["".join(rng.choices("etaoinsrhé中", k=rng.randint(1, 30))) for _ in range(3000)]
    spelled = [w.encode() for w in words]
    length = bytebpe.np.array([len(w) for w in spelled])
    ids, n = bytebpe.merge_words(bytebpe.np.frombuffer(b"".join(spelled), bytebpe.np.uint8), length, bytebpe.RankMaps(path))
    ends = n.cumsum()
    for w, end, k in zip(spelled, ends, n):
        assert ids[end - k : end].tolist() == library._core_bpe.encode_single_piece(w)
    assert max(seen) <= 1000 and bytebpe.BLOCK_BYTES <= 4 << 20
    plan = bytebpe.encode(docs("a text"), path, pattern)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_bpe_query(spark, docs, vocabulary, tmp_path):
    docs("one text", "", None).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in op11_byte_bpe(spark, str(tmp_path)).collect()}
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert rows[1].ids_sha256 == rows[2].decoded_sha256 == empty and rows[2].n_tokens == 0 and rows[0].n_tokens == 2


def plain_words(rows) -> Counter:
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


@pytest.mark.parametrize("bucket", [1, 256])
def test_variants(spark, area, docs, monkeypatch, bucket):
    monkeypatch.setattr(variants, "BUCKET_PAIRS", bucket)
    rng = random.Random(bucket)
    stems = ["".join(rng.choices("abcé", k=rng.randint(6, 9))) for _ in range(30)] + ["commonest" + x + y for x in "abcdefgh" for y in "uvwxyz"] + ["aaaaaaa", "ÀÉÎÕÜþÿ"]
    words = []
    for stem in stems:
        words += [stem] * rng.choice((1, 5, 9, 60))
        for _ in range(4):
            k = rng.randrange(len(stem))
            words += [rng.choice((stem[:k] + stem[k + 1 :], stem[:k] + rng.choice("abé") + stem[k:], stem[:k] + rng.choice("abé") + stem[k + 1 :]))] * rng.choice((2, 5, 6, 30))
    words += ["chain" + "x" * k for k in range(1, 5) for _ in range(6 ** (k - 1) * 5)]
    rng.shuffle(words)
    rows = [(k, " ".join(words[k::40]).title() if k % 2 else "-".join(words[k::40])) for k in range(40)] + [(40, None), (41, ""), (None, "Stray words"), (3, "repeated repeated")]
    n = plain_words(rows)
    links = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, all_ in links.items():
        best = min(all_, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    expected = sorted((w, form[w], root(w), n[w], len(links[w]), n[form[w]] if form[w] else None) for w in n)
    found = variants.group_variants(docs(*rows, extra="'x' AS word"), area)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == expected
    assert any(f and form[f] for f in form.values())  # a form of a form


def test_variants_of_nothing(spark, area, docs):
    assert variants.group_variants(docs("short words only", None), area).count() == 0


def plain_search(rows, items, top):
    terms = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(doc_id, Counter(terms(t)), len(terms(t))) for doc_id, t in rows if terms(t)]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c, n in held:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def random_texts(rng, count, size):
    names = [f"t{k}" for k in range(60)] + ["Été", "日本", "x_y", "A1"]
    return [" ".join(rng.choices(names, k=rng.randint(1, size))) for _ in range(count)]


@pytest.mark.parametrize("limits", [{}, {"DOC_TILE": 3, "ITEM_TILE": 2, "TERM_TILE": 4, "BATCH_ITEMS": 5}, {"EXACT": 10**11}])
def test_search(spark, area, docs, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(search, name, value)
    rng = random.Random(1)
    texts = random_texts(rng, 60, 30)
    rows = [*enumerate(texts), (70, None), (71, ""), (72, "?! ."), (80, texts[3]), (81, texts[3]), (None, texts[3]), (5, texts[5]), (90, "t1 " * 3000)]
    items = [*enumerate(random_texts(rng, 11, 12)), (20, None), (21, "unknown"), (22, "t1 " * 500), (23, texts[3])]
    given = spark.createDataFrame(items, "item_id bigint, text string").withColumn("rank", F.lit(1))
    found = search.search(docs(*rows, extra="1 AS score").repartition(4), given, area, top=7)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_search(rows, items, 7)


def test_search_of_nothing(spark, area, docs):
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert search.search(docs("x").where("false"), items, area).count() == 0
    assert search.search(docs("a"), items.where("false"), area).count() == 0
