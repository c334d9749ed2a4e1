"""MinHash near-duplicates, spelling variants and cross-tokenizer alignment against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from quarterdeck.llm import alignment, html_text, minhash, similar, spelling

DOCS = "doc_id long, text string"
ODD = [(0, None), (1, ""), (2, " \t\n"), (3, "a"), (4, "Zoë 日本語 \U0001f600"), (4, "Zoë 日本語 \U0001f600"), (5, "x" * 5000), (None, "some text"), (None, None), (7, "one two"), (8, "ONE  two")]


def docs(spark, rows, *extra):
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(1) for c in extra})


# --- minhash --------------------------------------------------------------------------------------------------------


def brute_components(rows, least=85):
    """(doc_id, size, component, kept) of each row; rows of equal sets are one node."""
    sets = [frozenset(similar.shingles(t, 3).tolist()) for _, t in rows]
    up = {s: s for s in sets}

    def root(s):
        while up[s] != s:
            s = up[s]
        return s

    known = [s for s in {s for s, (d, _) in zip(sets, rows) if d is not None} if s]
    for i, s in enumerate(known):
        for t in known[:i]:
            if 100 * len(s & t) >= least * len(s | t):
                up[root(s)] = root(t)
    out = []
    for s, (d, _) in zip(sets, rows):
        of = [e for t, (e, _) in zip(sets, rows) if e is not None and t and root(t) == root(s)] if s else [d]
        component = None if d is None else min(of)
        out.append((d, len(s), component, d is None or component == d))
    return sorted(out, key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def near_rows(seed, clusters=6, size=25):
    """Clusters whose members are at all similarities around the least of a link, chains among them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(clusters):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 20, 150, 400]))]
        for _ in range(size):
            text = edited(rng, words, rng.randint(0, len(words) // 30))
            words = text.split() if rng.random() < 0.4 else words
            rows.append((rng.randrange(10**6), text))
    rng.shuffle(rows)
    return rows


def found_components(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,tile", [(1, 2048), (2, 4)])
def test_near_sets(spark, seed, tile):
    rows = near_rows(seed)
    assert found_components(minhash.near_sets(docs(spark, rows), tile=tile)) == brute_components(rows)


def test_near_sets_of_odd_rows(spark):
    assert found_components(minhash.near_sets(docs(spark, ODD, "node", "n", "sig", "bucket", "component_id"))) == brute_components(ODD)
    assert minhash.near_sets(docs(spark, [])).collect() == []
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(3, long), (2, long + " more"), (1, "short text here")]
    assert [r[2] for r in found_components(minhash.near_sets(docs(spark, rows)))] == [1, 2, 2]


def test_one_hot_group_of_near_copies_is_not_paired(spark, monkeypatch):
    """Tiles get rows in proportion to the group, not to its pairs."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(120)]
    rows = [(k, edited(rng, words, 6)) for k in range(400)]
    made = {}
    keep = minhash.materialise
    monkeypatch.setattr(minhash, "materialise", lambda df, name: made.__setitem__(name, keep(df, name)) or made[name])
    found = found_components(minhash.near_sets(docs(spark, rows)))
    assert found == brute_components(rows)
    assert made["tiles"].count() <= 400 * minhash.VALUES < 400 * 399 / 2


def test_every_pair_within_the_radius_shares_a_key():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 16, (300, minhash.VALUES)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(minhash.VALUES, minhash.RADIUS, replace=False)
        row[at] ^= rng.integers(1, 1 << 16, minhash.RADIUS).astype(np.uint16)
    assert ((a != b).sum(1) == minhash.RADIUS).all()
    assert (minhash.chunk_keys(a) == minhash.chunk_keys(b)).any(1).all()


def test_pairs_at_the_least_similarity_are_within_the_radius():
    """At a similarity of 0.85 the distance passes the radius once in 1e5: not once in 300."""
    rng = np.random.default_rng(4)
    far = 0
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        far += (minhash.signature(both[:370]) != minhash.signature(both[30:])).sum() > minhash.RADIUS
    assert far == 0


# --- spelling -------------------------------------------------------------------------------------------------------


def edits(word):
    """All words one deletion away, with the place as a mark."""
    return {(word[:k] + "*" + word[k + 1 :]) for k in range(len(word))} | {word[:k] + "*" + word[k:] for k in range(len(word) + 1)}


def brute_words(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute_variants(n):
    marks = {}
    for w in n:
        for e in edits(w):
            marks.setdefault(e, set()).add(w)
    out, form = [], {}
    near = {w: {v for e in edits(w) for v in marks[e]} - {w} for w in n}
    for w, k in n.items():
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * k else None
    for w, k in n.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, k, len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def spelled_rows(seed, many=1500):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.choice([6, 7, 8, 9, 12, 30, 70, 130]))) for _ in range(40)]
    rows = []
    for k in range(many):
        words = []
        for _ in range(rng.randint(0, 12)):
            w = rng.choice(stems)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", rng.choice("abé"), w[at] + rng.choice("abé")]) + w[at + 1 :]
            words += [w.upper() if rng.random() < 0.2 else w] * rng.choice([1, 1, 1, 5])
        rows.append((rng.choice([k, None]), ", ".join(words)))
    return rows


@pytest.mark.parametrize("seed,tile", [(1, 1024), (2, 3)])
def test_variants(spark, seed, tile):
    rows = spelled_rows(seed)
    want = brute_variants(brute_words(rows))
    assert len(want) > 300 and sum(r[4] for r in want) > 1000
    assert sorted(tuple(r) for r in spelling.spelling_variants(docs(spark, rows), tile=tile).collect()) == want


def test_roots_follow_forms_to_the_last(spark):
    n = {"aaaaaaa": 10**7, "aaaaaab": 10**6, "aaaaabb": 10**5, "aaaabbb": 10**4, "aaabbbb": 10**3, "aabbbbb": 100, "abbbbbb": 10, "bbbbbbb": 1, "ccccccc": 3}
    got = sorted(tuple(r) for r in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute_variants(n)
    assert [r[2] for r in got] == ["aaaaaaa"] * 8 + ["ccccccc"]


def test_variants_of_odd_rows(spark):
    rows = [*ODD, (9, "x" * 100_000 + " " + "x" * 99_999), (10, "x" * 100_000 + " " + "x" * 99_999), (11, "Müller×÷Ab müller×÷ab ﬁshing"), (11, "Müller×÷Ab müller×÷ab ﬁshing")]
    n = brute_words(rows)
    got = sorted(tuple(r) for r in spelling.spelling_variants(docs(spark, rows, "word", "n", "form")).collect())
    assert [r[:1] + r[3:4] for r in got] == sorted(n.items())
    short = {w: k for w, k in n.items() if len(w) < 100}
    assert [r for r in got if len(r[0]) < 100] == brute_variants(short)
    assert [r[4] for r in got if len(r[0]) > 99_000] == [1, 1]
    assert spelling.spelling_variants(docs(spark, [])).collect() == []


# --- alignment ------------------------------------------------------------------------------------------------------


@cache
def whole_tokenizers():
    a, b = tokenizers.Tokenizer.from_file(alignment.A_FILE), sentencepiece.SentencePieceProcessor(model_file=alignment.B_FILE)
    a.encode_special_tokens = True
    return a, b


def brute_alignment(rows):
    """Whole texts through both tokenizers, links listed one by one."""
    a_tok, b_tok = whole_tokenizers()
    letter = alignment.byte_letters()
    held, documents = [], Counter()
    for d, t in rows:
        a, b = (a_tok.encode(" " + t, add_special_tokens=False), b_tok.encode(t)) if t else (None, [])
        a_bytes = [bytes(letter[c] for c in x) for x in a.tokens] if a else []
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b_tok.id_to_piece, b)]
        a = a.ids if a else []
        if not t or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + t).encode():
            a, b = [], []
        groups, i, j, x, y = [], 0, 0, 0, 0
        while i < len(a):
            s, e = i, j
            while True:
                if x <= y:
                    x += len(a_bytes[i])
                    i += 1
                else:
                    y += len(b_bytes[j])
                    j += 1
                if x == y:
                    break
            groups.append((a[s:i], b[e:j]))
        links = Counter((u, v) for g, h in groups for u in g for v in h)
        documents.update(links.keys())
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        held.append((d, len(a), len(b), len(groups), links, hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    best = Counter()
    for (u, _), n in documents.items():
        best[u] = max(best[u], n)
    return sorted(
        ((d, a, b, g, sum(links.values()), sum(k for x, k in links.items() if documents[x] == best[x[0]]), sum(k * documents[x] for x, k in links.items()), sha) for d, a, b, g, links, sha in held), key=repr
    )


ALIGNED = [
    *ODD, (20, " leading  and   many spaces "), (21, "tabs\tand\nlines \n then\n\n more"), (22, "it's we'll I'M 1234567 x=y;z!=w"), (23, "a▁b and more"), (24, "<|endoftext|> <s> </s> <unk> <0x41>"), (25, "naïve café — “quoted” …"), (26, " non breaking 　 wide"), (27, "é" * 300 + " " + "日本語テキスト" * 50), (28, "\x00\x01 \x1c \x1f control \x85 x"), (29, "ﬁ ligature ́ combining ḱ"),
    (30, "😀😃 👩‍👩‍👧 flags 🇩🇪"), (31, " "), (32, "  "), (33, "\n"), (34, "word " * 2000), (35, "the quick brown fox"), (35, "the quick brown fox"), (36, "The  Quick\r\n Brown"),
]


@pytest.mark.parametrize("remembered", [150_000, 3])
def test_alignment(spark, remembered, monkeypatch):
    rng = random.Random(3)
    pieces = [t for _, t in ALIGNED if t] + [" ", "\n", "  ", "ing", "tion", "'s"]
    rows = ALIGNED + [(100 + k, "".join(rng.choice(pieces)[: rng.randint(1, 30)] + rng.choice(["", " "]) for _ in range(20))) for k in range(60)]
    aligner = alignment.Aligner(alignment.Tokenizers.load())
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    for _ in range(2):  # the second time chunks are known, or forgotten
        for k in range(0, len(rows), 7):
            found = aligner.align([t for _, t in rows[k : k + 7]])
            for (d, t), n_a, n_b, n_links, sha in zip(rows[k:], found["n_a"], found["n_b"], found["n_links"], found["groups_sha256"]):
                want = brute_alignment([(d, t)])[0]
                assert (n_a, n_b, n_links, sha) == (want[1], want[2], want[4], want[7]), repr(t)
    got = sorted((tuple(r) for r in alignment.aligned(docs(spark, rows, "block", "pair", "row").repartition(3), aligner.both).collect()), key=repr)
    assert got == brute_alignment(rows)


def test_alignment_of_real_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in alignment.aligned(docs(spark, rows), alignment.Tokenizers.load()).collect()), key=repr)
    assert got == brute_alignment(rows)
    assert alignment.aligned(docs(spark, []), alignment.Tokenizers.load()).collect() == []


def test_no_row_holds_more_than_a_document_or_the_pairs_of_a_block(spark, monkeypatch):
    rows = [(k, "the quick brown fox naïve café qwrtpsdf xyzzy") for k in range(300)]
    stored = alignment.blocks(docs(spark, rows).coalesce(1), alignment.Tokenizers.load())
    lists = [f.name for f in stored.schema.fields if f.dataType.typeName() == "array"]
    longest = stored.select(F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in lists]).alias("n")).agg(F.max("n")).first()[0]
    assert 0 < longest <= len(rows[0][1]) * 4
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 100)
    many = [(k, "the fox" if k % 3 else "café xyzzy") for k in range(40)]
    assert sorted((tuple(r) for r in alignment.aligned(docs(spark, many).coalesce(1), alignment.Tokenizers.load()).collect()), key=repr) == brute_alignment(many)


def test_large_groups_are_counted_by_distinct_ids(spark, monkeypatch):
    rows = [(1, "日本語 xyzzy plugh"), (2, "qwrtpsdf")]
    want = brute_alignment(rows)
    monkeypatch.setattr(alignment, "LISTED", 0)
    found = alignment.Aligner(alignment.Tokenizers.load()).align([t for _, t in rows])
    assert np.bincount(found["row"], found["times"]).tolist() == [r[4] for r in want]


# --- pages ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("value", ["1", "1.5", "", "abc"])
def test_labels_are_read_from_training_pages_only(value):
    page = html_text.parse(f'<p data-y="{value}">text</p>')
    assert page.label == [-1, -1] and page.runs[0][1] == "text"
    assert html_text.parse('<p data-y="1">text</p>', labelled=True).label == [-1, 1]


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</p>" * 100_000, "<b>" * 100_000 + "<div></div>" * 50_000, "<p><td>" + "<b>" * 100_000 + "<div></div>" * 50_000, "<table>" + "<tr><td>" * 60_000, "<a>" * 50_000 + "</b>" * 50_000])
def test_badly_nested_pages_take_linear_time(page):
    began = time.process_time()
    html_text.parse(page)
    assert time.process_time() - began < 10


def text_of(html):
    page = html_text.parse(html)
    return html_text.kept_text(page, [True] * len(page.parent))


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold</p>", "Let x=2 hold"),
        ("<p>a <object data='x'>the <b>film</b></object> b</p>", "a the film b"),
        ("<p>a</p><noscript><p>b</p></noscript>c", "a b c"),
        ('<p title="1 > 0">a</p>', "a"),
        ("<p title='\">\"'>a<p>b", "a b"),
        ('<p title="x>a</p><p>b', "a b"),
        ('<a ">" <b>c', "c"),
        ("a<script>if (x > '</p>') y</script><style>p > a</style><svg><text>t</text></svg><svg/>b", "ab"),
        ("a<p", "a"),
    ],
)
def test_text_of_pages(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize("unit", ['<a ">" ', "<a '>' ", '<a x="', "<a x='\"", "<a \">'<b '>\" ", "<div>", "<b>", "<div></p>", "<math><mi>x", "<!-- ", "<![CDATA[", "</", "<noscript>", "<a class=\"", "&#"])
def test_pages_are_parsed_in_linear_time(unit):
    """A megabyte of what is never closed."""
    start = time.process_time()
    html_text.parse(unit * (1_000_000 // len(unit)))
    assert time.process_time() - start < 10


def test_tag_ends_are_those_of_a_plain_search():
    """With what earlier searches have found out, and without."""
    rng = random.Random(6)
    whole = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*>""")
    for _ in range(3000):
        text = "".join(rng.choice("<>\"'a ") for _ in range(rng.randint(0, 25)))
        lost: set[int] = set()
        for at in range(len(text) + 1):
            m = whole.match(text, at)
            k = text.find(">", at)
            assert html_text.tag_end(text, at, lost) == (m.end() - 1 if m else k if k >= 0 else len(text))
