"""The text operators against plain Python on small tables: nulls, empty and long texts, ties, repeated rows, empty tables."""

import hashlib
import html
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from modelmon.llm import (
    components, decontaminate, html_region, licenses, mixing, quality, queries, secrets, shingles, simhash, simple8b, trie_counts, warc,
)

WORDS = "the of and to in lorem ipsum dolor sit amet over under zebra quark".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(1, 120)
    rows = [
        (1, base, "en", "src1"), (2, base, "en", "src2"), (2, base, "en", "src2"), (3, base + " end", "en", None), (4, None, None, "src0"),
        (5, "", "en", "src0"), (6, " \n\t ", "de", "src0"), (7, prose(2, 20000), "en", "src0"), (None, prose(3, 80), "fr", "src0"),
        (8, "Two words", "en", "x"), (9, "Tab\tand  double \n space", "en", "src7"), (10, prose(4, 60) + "\n" + prose(4, 60), "en", "src0"),
        (11, "#*$% " * 100, "en", "src0"), (12, "Ünï çode 中文 <|endoftext|> it's 12", "de", "src3"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    return spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long")).withColumn("row", F.lit("clash")).withColumn(
        "fp", F.lit(0)
    ).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def plain_print(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_classes(prints):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def test_simhash(docs, empty):
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_print(r.text) for r in rows]
    roots = plain_classes(prints)
    low = {c: min((r.doc_id for r, k in zip(rows, roots) if k == c and r.doc_id is not None), default=None) for c in roots}
    expected = Counter((r.doc_id, f"{p:016x}", low[c]) for r, p, c in zip(rows, prints, roots))
    assert Counter(map(tuple, simhash.near_copies(docs).collect())) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    assert simhash.near_copies(empty).count() == 0 and simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("size", [5, 400])
def test_bucket_links_reach_all(size):
    rng = random.Random(size)
    members = np.array(sorted({0xABCDEF0000000000 | rng.getrandbits(16 if size > 9 else 3) for _ in range(size)}), dtype=np.uint64)
    pairs = simhash.bucket_links(members)
    label = {int(m): int(m) for m in members} | {int(b): int(a) for a, b in pairs}
    roots = plain_classes([int(m) for m in members])
    assert all(label[int(m)] == int(members[r]) for m, r in zip(members, roots))
    assert len(pairs) < len(members)


def test_links_find_every_close_pair(spark):
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = components.components(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"))).collect()
    roots = plain_classes(list(prints))
    together = {frozenset(s for s, r in zip(signed, roots) if r == c) for c in set(roots)}
    by_root = {}
    for r in found:
        by_root.setdefault(r.root, set()).add(r.node)
    assert {frozenset(s) for s in by_root.values()} == {t for t in together if len(t) > 1}


def plain_sets(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar_kept(rows):
    """The doc_ids that stay of (doc_id, text) rows when every two texts are compared."""
    sets, root = [plain_sets(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[i] if r == root[j] else r for r in root]
    return {min(rows[k][0] for k in range(len(rows)) if root[k] == c) for c in root}


def test_pipeline_drops_similar_texts(spark, empty):
    import corpus_pipeline

    rng = random.Random(11)
    wide = [f"w{i}" for i in range(3000)]
    texts = ["", None, " \n ", "two words", "Two  WORDS", "one two three four five", *(" ".join(rng.choices(WORDS, k=60)) for _ in range(20))]
    line = " ".join(wide[:30])
    for size in (12, 60, 300):
        for _ in range(12):
            base = rng.choices(wide, k=size)
            texts.append(" ".join(base))
            for edits in (1, 2, size // 60, size // 40, size // 25):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(size)] = rng.choice(wide)
                texts.append(" ".join(copy))
            texts.append(f"{line} {texts[-1]}")
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert len(kept) == len(set(kept)) and set(kept) == similar_kept(rows)
    assert shingles.keep_one(empty).count() == 0 and shingles.keep_one(empty).columns == empty.columns


def test_near_copies_start_from_fingerprints(spark, monkeypatch):
    base = [prose(i, 200).split() for i in range(4)]
    rows = [(i * 10 + k, " ".join(words + ["extra"] * k)) for i, words in enumerate(base) for k in range(3)]
    # Few shingles: one word more moves the fingerprint, whatever the classes make of it the sets are similar.
    short = [f"s{i}" for i in range(24)]
    rows += [(100, " ".join(short)), (101, " ".join(short + ["other"])), (102, None), (None, ""), (102, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    prints, asked = {t: simhash.fingerprint((t or "").encode()) for _, t in rows}, []
    classes, verified = simhash.classes, shingles._verified

    def seen(hashed):
        asked.append(Counter((r.doc_id, r.fp & (1 << 64) - 1) for r in hashed.collect()))
        return classes(hashed)

    def first(pairs, *rest):
        asked.append({(r.a, r.b) for r in pairs.collect()})
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash, "classes", seen)
    monkeypatch.setattr(shingles, "_verified", first)
    kept = sorted(r.doc_id for r in shingles.keep_one(docs).collect())
    assert kept == [0, 10, 20, 30, 100, 102]
    # Every text's fingerprint goes to the operator, its pairs are checked first, and no later step asks for those that held.
    assert asked[0] == Counter((i, prints[t]) for i, t in rows)
    near = {(min(a, b), max(a, b)) for a, b in asked[1]}
    assert near and not near & ({(min(a, b), max(a, b)) for a, b in asked[2]} | asked[3])


def test_near_copies_of_a_family_ask_for_few_pairs(spark, monkeypatch):
    rng = random.Random(5)
    wide = [f"w{i}" for i in range(5000)]
    base, rows = rng.choices(wide, k=300), []
    # Two copies are similar at six edits or fewer together, so most pairs share keys and are not.
    for i in range(120):
        copy = list(base)
        for at in rng.sample(range(300), 2 + i % 5):
            copy[at] = rng.choice(wide)
        rows.append((i, " ".join(copy)))
    rng.shuffle(rows)
    docs, asked, verified = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), [], shingles._verified

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(shingles, "_verified", counted)
    kept = [r.doc_id for r in shingles.keep_one(docs).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == similar_kept(rows)
    assert sum(asked[2:]) < 10 * len(rows)


def test_sketches_differ_in_no_more_than_the_sets():
    rng = np.random.default_rng(3)
    for size in (0, 1, 30, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 1 << 63, size, dtype=np.uint64)]))
        x, y = (np.frombuffer(shingles.sketch(s), np.uint64) for s in (a, b))
        assert len(x) * 64 == shingles.SKETCH and np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_stored_rows_need_no_copy(spark, tmp_path):
    text = prose(3, 70)
    rows = [(1, text, "x"), (1, text, "x"), (2, text, "y"), (None, text, "z"), (3, prose(4, 70), None), (None, None, "n")]
    spark.createDataFrame(rows, "doc_id long, text string, _metadata string").repartition(3).write.parquet(f"{tmp_path}/d")
    stored = spark.read.parquet(f"{tmp_path}/d")
    kept = shingles.keep_one(stored, stored=True)
    assert kept.columns == stored.columns
    assert Counter(map(tuple, kept.collect())) == Counter({(1, text, "x"): 1, (3, prose(4, 70), None): 1, (None, None, "n"): 1})


@pytest.mark.parametrize("high", [2, 50257, 2**63])
@pytest.mark.parametrize("n", [0, 1, 59, 60, 1023, 1025, 3000])
def test_simple8b_round_trip(high, n):
    values = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64)
    words, offsets = simple8b.pack(values)
    assert (simple8b.unpack(words, offsets, n) == values).all()


def test_token_files(docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    start, expected = 0, []
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [simple8b.END_ID]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(map(tuple, simple8b.token_table(docs, path, 3).collect())) == Counter(expected)
    assert simple8b.token_table(empty, path).count() == 0


def test_token_files_are_bounded(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(simple8b, "SEGMENT_IDS", 50)
    monkeypatch.setattr(simple8b, "FILE_SEGMENTS", 2)
    many = docs.unionByName(docs).unionByName(docs)
    simple8b.write_tokens(many, queries.tokenizer_path(queries.TOKENIZER), f"{tmp_path}/t", 1)
    assert len(list((tmp_path / "t").glob("part-*"))) > 1
    found = simple8b.digests(spark, f"{tmp_path}/t").orderBy("start").collect()
    assert len(found) == many.count()
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))


def test_pieces_equal_whole_calls():
    from tokenizers import Tokenizer

    path, rng = queries.tokenizer_path(queries.TOKENIZER), random.Random(5)
    parts = ["a", "bc", " ", "\n", "\n", ".", ",", "***", "!", "'s", "'", "é", "\t", "\r\n", "12", "<s>", "</s>", "#", "_", "\x1c", "漢", " x", " The"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    whole, encode = Tokenizer.from_file(path), simple8b.Encoder(path)
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at : at + 100], encode(texts[at : at + 100])):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def test_quality(docs, empty):
    got = Counter()
    for r in quality.quality(docs).collect():
        got[r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed] += 1
        assert not (r.base_failed and r.kept)
    expected = Counter()
    for r in docs.select("doc_id", "text").collect():
        words = WORD.findall(r.text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        symbols = len(re.findall(r"[#*$%&|<>]", r.text or ""))
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        expected[r.doc_id, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed] += 1
    assert got == expected
    assert quality.quality(empty).count() == 0
    assert quality.keep_good(docs).columns == docs.columns and quality.keep_good(empty).count() == 0


def test_junk_diverges(spark):
    good = [(i, prose(i, 150), "en") for i in range(40)]
    odd = [(100, " ".join(str(i * 7919) for i in range(150)), "en")]
    kept = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(good + odd, "doc_id long, text string, lang string")).collect()}
    assert not kept[100]


def test_junk_rejects_no_clean_text(spark):
    good = [(i, prose(i, 150), "en") for i in range(40)]
    table = lambda seed, n: " ".join(str(random.Random(seed * 9973 + k).getrandbits(40)) for k in range(n))
    rows_of_junk = [(100 + i, table(i, 150), "en") for i in range(20)]
    copies_of_junk = [(200 + i, table(7, 150), "en") for i in range(100)]
    for junk in (rows_of_junk, copies_of_junk, [(300, table(1, 40_000), "en")], rows_of_junk + copies_of_junk + [(300, table(1, 40_000), "en")]):
        docs = spark.createDataFrame(good + junk, "doc_id long, text string, lang string")
        kept = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
        assert kept == {i for i, _, _ in good}


def test_mixture_equals_sql(docs, empty):
    rows = docs.select("doc_id", "text", "lang", "source").toPandas()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    for r in rows.itertuples():
        con.execute("INSERT INTO documents VALUES (?, ?, ?, ?)", [None if r.doc_id != r.doc_id else int(r.doc_id), r.text, r.lang, r.source])
    expected = con.execute(queries.ORACLE["op8_mixing"]).fetchall()
    assert Counter(map(tuple, mixing.mixture(docs).collect())) == Counter(expected)
    assert mixing.mixture(empty).count() == 0 and mixing.take(empty).columns == empty.columns
    taken = mixing.take(docs, epochs=1)
    assert taken.columns == docs.columns and 0 < taken.count() < docs.count()


def test_decontamination(spark, docs, empty):
    question, answer = "Which quark was found under the zebra in the garden of amet last year?", "It was the charming violet one of seven."
    items = spark.createDataFrame(
        [(1, f"{question} {answer}"), (2, "A wholly different item about copper kettles and their makers."), (3, None), (4, ""), (5, f"{question} {answer}")],
        "item_id long, text string",
    )
    more = docs.unionByName(
        spark.createDataFrame([(90, prose(8, 300) + " " + f"{question.upper()} {answer} " + prose(9, 300)), (91, prose(8, 200) + " " + question[:30])], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(more, items).collect()}
    assert found == {(90, 1), (90, 5)}
    kept = decontaminate.keep_clean(more, items)
    assert kept.columns == more.columns and kept.count() == more.count() - 1 and kept.where("doc_id = 90").count() == 0
    assert decontaminate.contaminated(empty, items).count() == 0 and decontaminate.contaminated(more, items.limit(0)).count() == 0


def test_wand_equals_scoring_everything():
    rng = random.Random(3)
    items = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randint(5, 90)))) for i in range(150)]
    parts = [t[a : a + 64] for t in (sum(decontaminate.question_and_answer(x), []) for _, x in items) for a in range(0, len(t), 64)]
    df = Counter(w for p in parts for w in set(p))
    index = decontaminate.Index(items, df, len(parts), sum(map(len, parts)) / len(parts))
    for _ in range(100):
        terms = set(rng.sample(range(len(index.vocabulary)), min(60, len(index.vocabulary))))
        scores = Counter()
        for t in terms:
            for part, share in zip(index.parts[t], index.shares[t]):
                scores[part] += share
        for threshold in (0.2, 0.5):
            assert {p for p, _ in index.search(sorted(terms), threshold)} == {p for p, s in scores.items() if s >= threshold - 1e-9}


def test_secrets(spark, docs, empty):
    rng = random.Random(5)
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(60)]
    texts = [f"{prose(i, 9)} token = \"{rng.getrandbits(160):040x}\" é {k} x" for i, k in enumerate(keys)]
    texts += ["secret: \"token\": \"abcdefghij\"", "PassWord=abc token:abcdefgh AKIASHORT", f"left {rng.getrandbits(120):030x} right", "card 4785380592391139 paid", None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    rows = {r.doc_id: r for r in secrets.secrets(table).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        spans = [("assign", *m.span()) for m in pattern.finditer(text) if len(m[2]) >= 8]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        counts = Counter(s[0] for s in spans)
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == (counts["assign"], counts["access"], counts["hex"])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(rows[i].spans.split(","))
    assert rows[62].n_format == 1 and rows[63].n_format == 0
    assert secrets.secrets(empty).count() == 0 and secrets.secrets(docs).count() == docs.count()


def test_candidates_free_of_spans():
    rng = random.Random(9)
    for _ in range(300):
        cuts = sorted(rng.sample(range(60), 10))
        found = [(a, b, "") for a, b in zip(cuts[::2], cuts[1::2])]
        taken = sorted((("hex", a, a + rng.randint(1, 25), "") for a in rng.sample(range(60), rng.randint(0, 4))), key=lambda s: s[1])
        plain = [c for c in found if not any(c[0] < e and s < c[1] for _, s, e, _ in taken)]
        assert secrets.free_of(found, taken) == plain


def test_trie_counts(docs, empty):
    pieces = {"▁": -3.0, "a": -2.0, "b": -2.5, "▁a": -2.2, "ab": -3.0, "▁ab": -4.5, "ba": -3.1}

    def plain(word):
        best = {0: (0.0, 0)}
        for end in range(1, len(word) + 1):
            options = [(best[s][0] + pieces[word[s:end]], -best[s][1] - 1) for s in range(end) if word[s:end] in pieces]
            if word[end - 1] not in pieces:
                size = len(word[end - 1].encode())
                options.append((best[end - 1][0] + size * min(pieces.values()), -best[end - 1][1] - size))
            score, n = max(options)
            best[end] = (score, -n)
        return best[len(word)]

    rng = random.Random(1)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(200)}
    for word, n, score in trie_counts.score_words(words, pieces):
        assert (round(score, 9), n) == (round(plain("▁" + word)[0], 9), plain("▁" + word)[1])
    path = queries.tokenizer_path(queries.UNIGRAM)
    counter = trie_counts.Counter(path)
    got = Counter((r.doc_id, r.n_pretokens, r.n_tokens) for r in trie_counts.token_counts(docs, path).collect())
    assert got == Counter((r.doc_id, *counter([r.text])[0][:2]) for r in docs.collect())
    assert all(n == len(WORD.findall(t or "")) for (_, t), (n, _, _) in ((r, counter([r[1]])[0]) for r in docs.select("doc_id", "text").collect()))
    assert trie_counts.token_counts(empty, path).count() == 0


def test_warc(spark, tmp_path):
    rows = [(5, "u", "<p>x</p>" * 400), (2, "v", "<p>x</p>" * 400), (2, "v", "<p>x</p>" * 400), (7, None, None), (8, "w", ""), (None, "n", "é" * 9), (9, "a\nb", "é" * 9)]
    rows += [(i, f"http://h/{i}", prose(i, 300)) for i in range(20, 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit(1)).repartition(2)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    expected = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        response = first.get(h or "") == i
        digest = warc.base32_digest(hashlib.sha1(data).hexdigest())
        expected[i, len(data), digest, "response" if response else "revisit", None if response else first[h or ""]] += 1
    assert Counter(map(tuple, warc.archive(pages).collect())) == expected
    assert warc.archive(pages.limit(0)).count() == 0
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    heads = [open(os.path.join(path, f), "rb").read(4) for f in os.listdir(path) if f.startswith("part")]
    assert heads and all(h == warc.DICTIONARY_MAGIC.to_bytes(4, "little") for h in heads if h)


def test_main_text(spark):
    page = (
        '<html><head><title>t</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><div class="ad">buy now</div>'
        "<article><h1>Head &amp; line</h1><p>One <b>t</b>wo&nbsp;three<p>Four<script>var x='</p>'</script> five<form>sign up</form>"
        '<div id="comments"><p>nice</p></div><p>six\n\n seven</article><footer>&copy; all rights</footer>'
    )
    rows = [(1, "a", page), (1, "a", page), (2, None, None), (3, "c", ""), (None, "d", "<p>plain words &lt;3 and more</p>"), (4, "e", "<p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = Counter((r.page_id, r.text, r.n_chars) for r in html_region.extract(pages).collect())
    want = "Head & line One two three Four five six seven"
    assert found == Counter({(1, want, len(want)): 2, (2, "", 0): 1, (3, "", 0): 1, (None, "plain words <3 and more", 23): 1, (4, "", 0): 1})
    assert html_region.extract(pages.limit(0)).count() == 0


def test_licences(spark):
    mit = licenses.TEMPLATES[1][1]
    rows = [
        (1, "a/b/c.txt", "x"), (2, "a/LICENSE", mit + " and so on"), (3, "a/b/d/e.py", "# Licensed under the Apache License, Version 2.0\ncode"),
        (4, "z/y.txt", None), (5, None, ""), (6, "a/b/d/f.py", "code"), (6, "a/b/d/f.py", "code"), (7, "q/r.txt", "a license to thrill"),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("dir", F.lit(0))
    found = Counter((r.doc_id, r.license, r.origin, r.from_directory) for r in licenses.licences(files).collect())
    assert found == Counter({
        (1, "MIT", "inherited", "a"): 1, (2, "MIT", "own", None): 1, (3, "Apache-2.0", "own", None): 1, (4, None, None, None): 1,
        (5, None, None, None): 1, (6, "MIT", "inherited", "a"): 2, (7, None, None, None): 1,
    })
    near = {r.doc_id: r.license for r in licenses.licences(files, named_only=False).collect()}
    assert near[6] == "Apache-2.0" and near[1] == "MIT"
    assert licenses.licences(files.limit(0)).count() == 0


def test_pages_unescape_once():
    assert html_region.main_text("<p>&amp;lt;</p>", {}) == html.unescape("&amp;lt;")


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = queries.table(spark, sf_dir, "documents")
    bench = queries.table(spark, sf_dir, "benchmark")
    final = corpus_pipeline.run(spark, sf_dir)
    good = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    left = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    one = similar_kept(sorted(left.items()))
    leaked = {i for i in one for b in bench.collect() if b.text.strip() in left[i]}
    clean = one - leaked
    con = duckdb.connect()
    documents = docs.where(F.col("doc_id").isin(sorted(clean))).toPandas()  # noqa: F841
    mixed = con.execute(f"WITH {queries.mixture_sql('documents', mixing.SHARE, 1)} SELECT doc_id FROM mixed WHERE copies > 0").fetchall()
    assert {r.doc_id for r in final.collect()} == {r[0] for r in mixed}
