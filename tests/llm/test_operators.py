"""The operators against brute force, on small and odd inputs."""

import hashlib
import math
import random
import re
import struct
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quarterdeck.llm import html_text, langid, mixing, pieces, pii, simhash, substrings, topk, toxicity, weighted_minhash

DOCS = "doc_id long, text string"
ODD = [(0, None), (1, ""), (2, " \t\n"), (3, "a"), (4, "Zoë 日本語 \U0001f600"), (4, "Zoë 日本語 \U0001f600"), (5, "x" * 5000), (None, "some text"), (7, "one two")]


def docs(spark, rows, extra=False):
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(1) for c in ("score", "h", "fp", "v", "size", "bucket", "token_ids", "kind")}) if extra else df


# --- substrings -----------------------------------------------------------------------------------------------------


def brute_repeats(rows):
    seen, covered = {}, []
    keyed = sorted(((1 << 63) - 1 if d is None else d, (t or "").encode(), k) for k, (d, t) in enumerate(rows))
    for d, b, _ in keyed:
        for i in range(len(b) - 99):
            seen[b[i : i + 100]] = min(seen.get(b[i : i + 100], (d, i)), (d, i))
    for d, b, k in keyed:
        cut = bytearray(len(b))
        for i in range(len(b) - 99):
            if seen[b[i : i + 100]] < (d, i):
                cut[i : i + 100] = b"\1" * 100
        kept = bytes(x for x, c in zip(b, cut) if not c)
        covered.append((rows[k][0], len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(cut))), hashlib.sha256(kept).hexdigest()))
    return Counter(covered)


def repeats_of(df):
    return Counter(tuple(r) for r in substrings.remove_repeats(df).drop("kept").collect())


def repeating_rows(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for k in range(60):
        text = " ".join(word() for _ in range(rng.randint(0, 120)))
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, 150)
            text = text[: rng.randint(0, len(text))] + passage[a : a + rng.randint(50, 250)] + text[rng.randint(0, len(text)) :]
        rows.append((rng.choice([k, k, k, 0, None]), text))
    rows += [(100, "ab" * 400), (101, "a" * 700), (102, "a" * 150), *rows[:3], (103, None), (104, "short")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed):
    rows = repeating_rows(seed)
    assert repeats_of(docs(spark, rows)) == brute_repeats(rows)


def test_repeats_of_hot_anchors_and_split_blocks(spark, monkeypatch):
    rows = repeating_rows(3)

    find = substrings._find_anchors

    def shrunk(batches, find=find):
        import quarterdeck.llm.substrings as s

        before = s.HOT, s.BLOCK
        s.HOT, s.BLOCK = 3, 1500
        try:
            yield from find(batches)
        finally:
            s.HOT, s.BLOCK = before

    monkeypatch.setattr(substrings, "_find_anchors", shrunk)
    monkeypatch.setattr(substrings, "LARGE", 4)
    assert repeats_of(docs(spark, rows)) == brute_repeats(rows)


def shrunk(run, **constants):
    """``run`` with other constants of its module, in the worker that it runs in."""

    def inner(batches):
        import quarterdeck.llm.substrings as s

        before = {k: getattr(s, k) for k in constants}
        for k, v in constants.items():
            setattr(s, k, v)
        try:
            yield from run(batches)
        finally:
            for k, v in before.items():
                setattr(s, k, v)

    return inner


@pytest.mark.parametrize("remembered", [2, 1000])
def test_repeats_of_a_passage_in_every_block(spark, monkeypatch, remembered):
    """Groups that are sorted in many chunks, contexts that a task has met before, and steps within a block."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 6)))
    passage, other = (" ".join(word() for _ in range(50)) for _ in range(2))
    rows = [(rng.choice([k, k, None]), " ".join(word() for _ in range(40)) + passage + word() * 3 + (other[k % 7 :] if k % 3 else "")) for k in range(150)]
    monkeypatch.setattr(substrings, "_find_anchors", shrunk(substrings._find_anchors, STEP=150, BLOCK=700, REMEMBERED=remembered))
    monkeypatch.setattr(substrings, "_sort_contexts", shrunk(substrings._sort_contexts, CHUNK=7))
    monkeypatch.setattr(substrings, "_cut", shrunk(substrings._cut, EMIT=2000))
    assert repeats_of(docs(spark, rows)) == brute_repeats(rows)


def test_repeats_of_very_long_texts(spark):
    rng = random.Random(22)
    words = [f"w{rng.randrange(10**6)}" for _ in range(15_000)]
    long = " ".join(words)
    rows = [(1, "a" * 1_000_000), (2, "ab" * 500_000), (3, long), (4, long[50_000:] + "x"), (None, long[20_000:30_000] * 3), (None, "a" * 200)]
    assert repeats_of(docs(spark, rows)) == brute_repeats(rows)


def test_repeats_of_odd_rows(spark):
    assert repeats_of(docs(spark, ODD, extra=True).select("doc_id", "text")) == brute_repeats(ODD)
    assert repeats_of(docs(spark, []).select("doc_id", "text")) == Counter()


def test_suffix_sort_is_the_plain_sort():
    rng = random.Random(5)
    contexts, left = [], []
    for _ in range(300):
        body = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 68)))
        k = rng.randint(0, 5)
        contexts.append(b"x" * k + b"g" * substrings.GRAM + body)
        left.append(k)
    group = np.array(sorted(rng.randint(0, 3) for _ in contexts))
    order, shared = substrings.Suffixes(group, np.array(left), contexts).checked()
    tail = [c[k + substrings.GRAM :] for c, k in zip(contexts, left)]
    want = sorted(range(300), key=lambda i: (group[i], tail[i]))
    assert [(group[i], tail[i]) for i in order] == [(group[i], tail[i]) for i in want]
    for a, b, n in zip(order[:-1], order[1:], shared[1:]):
        assert n == (substrings._shared(tail[a], tail[b]) if group[a] == group[b] else -1)


def test_hash_collisions_are_caught(monkeypatch):
    monkeypatch.setattr(substrings.PrefixHashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    gram = b"g" * substrings.GRAM
    contexts = [b"a" * 68 + gram + b"b" * 68, b"c" * 68 + gram + b"d" * 68, b"a" * 68 + gram + b"z" * 68]
    found, a, b = substrings.repeated(np.zeros(3, int), np.array([1, 2, 3]), np.array([100, 100, 100]), np.array([68] * 3), contexts)
    assert (found.tolist(), a.tolist(), b.tolist()) == ([2], [32], [132])


# --- pieces ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.load()


def best_score(model, word):
    """The best sum by trying all segmentations, longest piece first, without the trie."""
    by_text = {t: i for i, t in enumerate(model.texts) if i not in set(model.byte_ids.tolist()) and t}
    text, best = word.decode(), [0.0]
    for e in range(1, len(text) + 1):
        found = [best[s] + model.scores[by_text[p]] for s in range(e) if (p := text[s:e].encode()) in by_text]
        one = text[e - 1].encode()
        best.append(max([*found, *([best[e - 1] + model.unknown_score] if one not in by_text else [])]))
    return best[-1]


def test_pieces_are_the_best(model):
    words = ["▁hello", "▁the", "▁▁▁x", "ñandú", "\n\n", "日本𝄞語", "▁" * 40, "a" * 140, "▁zxqé%%%", "▁Über.\nAll"]
    for word, ids in zip(words, model.segment([w.encode() for w in words])):
        by_bytes = set(model.byte_ids.tolist())
        unknown = sum(1 for c in word if c.encode() not in set(model.texts) or (len(c.encode()) == 1 and ord(c) < 32))
        score = sum(model.scores[i] for i in ids if i not in by_bytes) + unknown * model.unknown_score
        assert score == pytest.approx(best_score(model, word.encode()), abs=1e-6), word
        assert b"".join(model.texts[i] for i in ids).decode() == word
        assert (model._alone(word.encode()) == ids).all()


def test_scores_of_a_file():
    """Log probabilities stay as they are; ranks become logarithms."""
    given = np.array([0.0, -1.5, -2.25, -9.0])
    assert pieces.log_scores(given, [1, 2, 3]).tolist() == [0, -1.5, -2.25, -9.0]
    ranks = pieces.log_scores(np.array([0.0, -0.0, -1.0, -2.0]), [1, 2, 3])
    assert np.exp(ranks[1:]).sum() == pytest.approx(1) and ranks[1] - ranks[3] == pytest.approx(np.log(3))


def test_round_trip_and_odd_rows(spark, model):
    df = docs(spark, ODD, extra=True)
    out = pieces.encode(df, model)
    assert out.columns[:2] == ["doc_id", "text"] and out.where("not round_trip").count() == 0 and out.count() == len(ODD)
    back = pieces.decode(out.select("doc_id", "token_ids"), model)
    assert Counter(r.text for r in back.collect()) == Counter((t or "") for _, t in ODD)
    assert pieces.encode(docs(spark, []), model).count() == 0
    assert model.decode([0, 1, 5]) == model.decode([5]) and pieces.Encoder(model).encode(["▁"])[0].tolist() == pieces.Encoder(model).encode([" "])[0].tolist()


# --- language, toxicity, pages --------------------------------------------------------------------------------------


def test_language(spark):
    rng = random.Random(1)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(40))
    texts = [(make("abcd"), "x") for _ in range(60)] + [(make("wyzé"), "y") for _ in range(60)]
    net = langid.train([t for t, _ in texts], [l for _, l in texts], epochs=6)
    rows = [(k, make("abcd" if k % 2 else "wyzé")) for k in range(40)] + [(90, None), (91, ""), (92, "12 !?"), (93, "b"), (93, "b"), (94, make("abcd") * 300)]
    got = langid.identify(docs(spark, rows, extra=True), net).collect()
    pred = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows) and all(pred[k] == ("x" if k % 2 else "y") for k in range(40)) and pred[94] == "x"
    assert pred[90] == pred[91] == pred[92] == "und" and all(0 <= r.score <= 1 for r in got)
    assert langid.identify(docs(spark, []), net).count() == 0
    held = spark.range(200).select("id", langid.learnable(F.col("id")).alias("ok")).collect()
    import zlib

    assert all(r.ok == (zlib.crc32(str(r.id).encode()) % 4 != 2) for r in held)


def test_convolution_against_loops():
    net = langid.train(["abc abc", "xyz xyz"], ["a", "b"], epochs=1)
    x = langid.windows_of("hello wörld".encode())
    e = net.embed[np.concatenate([x[0], np.zeros(3, np.uint8)])]
    by_hand = [max(sum(float(e[p + o] @ net.filters[o * langid.EMBED : (o + 1) * langid.EMBED, f]) for o in range(4)) for p in range(langid.WINDOW)) for f in range(net.filters.shape[1])]
    assert np.allclose(net.pooled(x)[0][0], np.maximum(np.array(by_hand) + net.bias, 0), atol=1e-4)


def test_toxicity(spark):
    rng = random.Random(2)
    words = ["tree", "house", "water", "stone", "cloud", "river", "light", "green"]
    clean = lambda: ". ".join(" ".join(rng.choice(words) for _ in range(6)) for _ in range(rng.randint(1, 5)))
    texts = [clean() for _ in range(200)] + [clean() + ". you " + rng.choice(["badword", "awful"]) + " " + rng.choice(words) + ". " + clean() for _ in range(60)]
    model = toxicity.train(texts, [0] * 200 + [1] * 60)
    rows = [(1, clean()), (2, clean() + ". Total BADWORD here. " + clean()), (3, None), (4, ""), (5, "!!"), (5, "!!"), (6, (clean() + ". ") * 500)]
    got = {r.doc_id: r for r in toxicity.score(docs(spark, rows, extra=True), model).collect()}
    assert got[2].score >= toxicity.THRESHOLD and "BADWORD" in got[2].worst_sentence and got[2].n_offending == 1
    assert all(got[k].score < toxicity.THRESHOLD for k in (1, 3, 4, 5, 6)) and got[3].n_sentences == 0
    kept = toxicity.drop_toxic(docs(spark, rows, extra=True), model)
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, 5, 6]) and kept.columns == docs(spark, rows, extra=True).columns
    assert toxicity.score(docs(spark, []), model).count() == 0
    assert toxicity.noisy_or([0.5, 0.5]) == pytest.approx(0.75) and toxicity.noisy_or([]) == 0


def test_toxicity_gradient_and_score():
    """The gradient against differences of the loss, and the loss against the scores that the model gives the texts."""
    rng = random.Random(5)
    words = ["vile", "vilest", "awful", "tree", "stone", "rain"]
    texts = [". ".join(" ".join(rng.choice(words) for _ in range(3)) for _ in range(rng.randint(0, 4))) for _ in range(12)]
    y = np.array([k % 3 == 0 for k in range(12)], float)
    kept = ["vile", "vile*", "vilest", "awful"]
    bags = [toxicity.sentence_features(t, {f: k for k, f in enumerate(kept)}) for t in texts]
    alike = [(d, m, n) for d, b in enumerate(bags) for m, n in b.items() if m]
    lists = (
        np.log1p([sum(b.values()) for b in bags]), np.array([d for d, _, _ in alike]), np.array([n for _, _, n in alike], float),
        np.repeat(np.arange(len(alike)), [len(m) for _, m, _ in alike]), np.array([c for _, m, _ in alike for c in m]),
    )
    at, cost = np.array([0.7, 0.4, -0.3, 1.1, -1.5, -2.0, 0.3]), np.full(12, 1 / 12)
    loss = lambda p: toxicity.loss_and_gradient(p, lists, y, cost, 0.01)[0]
    step = np.eye(7) * 1e-6
    assert np.allclose([(loss(at + s) - loss(at - s)) / 2e-6 for s in step], toxicity.loss_and_gradient(at, lists, y, cost, 0.01)[1], atol=1e-6)
    model = toxicity.SentenceModel(dict(zip(kept, at[:4].tolist())), at[4], (at[5], at[6]))
    scores = np.array([model.document_score(model.sentence_scores(t)) for t in texts])
    assert loss(at) == pytest.approx((-(y * np.log(scores) + (1 - y) * np.log(1 - scores))).mean() + 0.005 * (at[:4] ** 2).sum())


def test_held_out_rows_teach_nothing(spark, tmp_path):
    """Whole queries: other labels and languages of held-out rows change no prediction."""
    rng = random.Random(6)
    letters = {"x": "abcdef", "y": "uvwxyz"}
    make = lambda lang, n: " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randint(3, 7))) for _ in range(n))
    rows = []
    for k in range(160):
        lang, bad = "xy"[k % 2], k % 5 == 0
        rows.append((k, f"{make(lang, 20)}. {'vile scum. ' if bad else ''}{make(lang, 8)}", lang, int(bad)))
    import zlib

    held = {k for k, *_ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    got = []
    for turn in (False, True):
        folder = tmp_path / f"turned-{turn}"
        mine = [(k, t, "q" if turn and k in held else l, 1 - y if turn and k in held else y) for k, t, l, y in rows]
        spark.createDataFrame([(k, t, l, "s", len(t)) for k, t, l, _ in mine], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(k, 1, y) for k, _, _, y in mine], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        got.append([sorted(q(spark, str(folder)).select("doc_id", "held_out", pred, "score").collect()) for q, pred in ((langid.op3_language_id, "lang_pred"), (toxicity.op5_toxicity, "predicted"))])
    assert got[0] == got[1]
    assert {r.doc_id for r in got[0][0] if r.held_out} == held
    assert all(r.lang_pred == "xy"[r.doc_id % 2] for r in got[0][0] if r.held_out) and all(r.predicted == (r.doc_id % 5 == 0) for r in got[0][1] if r.held_out)


def test_language_windows_come_from_whole_texts():
    text = "a" * 100_000 + "b" * 100_000
    w = langid.drawn_windows(text)
    assert w.shape == (langid.SAMPLE_WINDOWS, langid.WINDOW) and {ord("a"), ord("b")} <= set(w[:, 0].tolist()) and (langid.drawn_windows(text) == w).all()


def test_toxicity_learns_from_whole_texts(spark):
    """What offends late in long texts is learned as well, and as from the same texts in memory."""
    rng = random.Random(4)
    words = ["tree", "house", "water", "stone", "cloud", "river", "light", "green"]
    clean = lambda n: " ".join(" ".join(rng.choice(words) for _ in range(6)) + "." for _ in range(n))
    rows = [(k, clean(300) + (" you badword here." if k % 4 == 0 else "")) for k in range(120)]
    assert all(len(t) > 9_000 for _, t in rows)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k, _ in rows], "doc_id long, toxic int")
    model = toxicity.fitted(docs(spark, rows), labels)
    known = [r[0] for r in spark.range(120).where(toxicity.learnable(F.col("id"))).collect()]
    plain = toxicity.train([rows[k][1] for k in known], [int(k % 4 == 0) for k in known])
    assert model.weights.keys() == plain.weights.keys() and all(model.weights[f] == pytest.approx(x, abs=1e-6) for f, x in plain.weights.items())
    got = {r.doc_id: r.score for r in toxicity.score(docs(spark, rows), model).collect()}
    assert all((got[k] >= toxicity.THRESHOLD) == (k % 4 == 0) for k, _ in rows)
    assert toxicity.fitted(docs(spark, rows), labels.where("toxic = 0")).weights == {}


PAGE = '<html><head><title>T</title><style>p{x}</style></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/x">More</a></li></ul></nav><!-- ad --><div class="ad">Buy this now.</div><article><h1>A  title</h1><p><b>First&amp;\n second words, and more of it. And on.<br>line<p>Third &lt;p&gt; one, two three.</p></article><footer>&copy; someone</footer>'


def test_pages(spark):
    texts = [PAGE.replace("First", f"Word{k} and so on, with some length to it").replace("Third", "Other things are said here") for k in range(30)]
    model = html_text.train(texts)
    schema = "page_id long, url string, html string, text string"
    rows = [(1, "u", PAGE, "clash"), (2, "u", None, ""), (3, None, "", ""), (4, "u", PAGE * 2, ""), (4, "u", PAGE * 2, ""), (5, "u", "<p", ""), (6, "u", "<div>" * 3000 + "deep", "")]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, schema), model).collect()}
    want = "A title First& second words, and more of it. And on. line Third <p> one, two three."
    assert got[1].text == want and got[1].n_chars == len(want) and got[2].text == got[3].text == "" and got[3].url is None
    assert html_text.extract(spark.createDataFrame([], schema), model).count() == 0
    page = html_text.parse(PAGE)
    keep = html_text.decode(page.parent, np.random.default_rng(0).normal(size=len(page.parent)))
    assert all(keep[p] or not k for p, k in zip(page.parent[1:], keep[1:]))


def test_pages_without_articles(spark):
    """Pages of plain div mark-up lose their boilerplate too, and so do those of a sample without text."""
    text = lambda k: f"Word{k} and so on, with some length to it, and then a good deal more that was said at the time. " * 3
    page = lambda k: f'<html><body><div class="menu"><ul><li><a href="/">Home</a></li><li><a href="/x">More</a></li></ul></div><div class="content"><p>{text(k)}</p><p>Other things, {text(k + 1)}</p></div><div class="footer">Copyright someone</div></body></html>'
    rows = [(k, "u", page(k)) for k in range(30)]
    for sample in ([h for _, _, h in rows], []):
        got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), html_text.train(sample)).collect()
        assert all(f"Word{r.page_id} and" in r.text and "Home" not in r.text and "Copyright" not in r.text for r in got)


def test_tree_decoding_is_the_best():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = 7
        parent = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        odds = rng.normal(size=n) * 2
        score = lambda keep: sum(-np.logaddexp(0, -o if k else o) for k, o in zip(keep, odds))
        legal = [k for m in range(2**n) if (k := [bool(m >> i & 1) for i in range(n)]) and all(k[parent[i]] or not k[i] for i in range(1, n))]
        assert score(html_text.decode(parent, odds)) == pytest.approx(max(map(score, legal)))


# --- masking --------------------------------------------------------------------------------------------------------


def test_masking(spark):
    rows = [(1, "mail me.x@site.example.com, again me.x@site.example.com"), (2, "card 4111111111111111 4111 1111 1111 1111 no 4111111111111112"), (3, "on 2020-02-29 and 29/02/2020, not 2021-02-29"), (4, "+1 (017) 555-7713"), (5, "10.2.3.4."), (6, "123-45-6789"), (7, "DE89370400440532013000"), (8, "clean text 12 and 2024 words"), *[(k + 10, t) for k, (_, t) in enumerate(ODD)]]
    df = docs(spark, rows, extra=True)
    out = pii.mask(df, "key")
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == [*df.columns, "_pii_kinds"]
    a, b = re.findall(r"\S+@pseudonym\.invalid", got[1].text)
    assert a == b and "site" not in got[1].text
    one, two = re.search(r"card (\d{16}) ([\d ]{19}) no 4111111111111112", got[2].text).groups()
    digits = [int(d) for d in one]
    assert one == two.replace(" ", "") and one != "4111111111111111" and sum(d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0
    y, d = re.search(r"on (\S+) and ([^,]+), not 2021-02-29", got[3].text).groups()
    assert "/".join(reversed(y.split("-"))) == d and y != "2020-02-29"
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[4].text) and re.fullmatch(r"(\d{1,3}\.){4}", got[5].text) and re.fullmatch(r"\d{3}-\d{2}-\d{4}", got[6].text)
    iban = got[7].text
    assert iban.startswith("DE") and int(iban[4:] + "1314" + iban[2:4]) % 97 == 1 and got[7]._pii_kinds == ["iban"]
    for r in out.where("doc_id >= 8").collect():
        assert r.text == dict(rows)[r.doc_id] and r._pii_kinds == []
    assert pii.mask(docs(spark, []), "key").count() == 0
    assert got[4].text != pii.mask(df, "other key").where("doc_id = 4").first().text


def mod97(s):
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_account_numbers(spark):
    """Of every class of characters; within words; lower case; wrong ones stay. The pseudonyms are valid and linked."""
    given = ["SC18SSCB11010000000000001497USD", "MT84MALT011000012345MTLCAST001S", "GB82WEST12345698765432", "DE89370400440532013000", "NO9386011117947", "LC55HEMM000100010012001200023015"]
    rows = [(k, f"pay {i} or {i.lower()} now") for k, i in enumerate(given)]
    rows += [(50, "pay DE89 3704 0044 0532 0130 00 THEN rest, ES91 2100 0418 4502 0005 1332 THEN"), (51, "DE89370400440532013001 de8937040044053201300 ab12cdefghijklmnop")]
    got = {r.doc_id: r for r in pii.mask(docs(spark, rows), "k").collect()}
    for k, i in enumerate(given):
        assert mod97(i) == 1
        new, low = re.fullmatch(r"pay (\w+) or (\w+) now", got[k].text).groups()
        assert low == new.lower() and new != i and new[:2] == i[:2] and mod97(new) == 1 and re.sub("[A-Z]", "a", re.sub("[0-9]", "0", new)) == re.sub("[A-Z]", "a", re.sub("[0-9]", "0", i))
    one, two = re.fullmatch(r"pay (.*) THEN rest, (.*) THEN", got[50].text).groups()
    assert one.replace(" ", "") == re.search(r"DE\w+", got[3].text)[0] and re.sub("[0-9]", "0", two) == "ES00 0000 0000 0000 0000 0000" and mod97(two.replace(" ", "")) == 1
    assert got[51].text == dict(rows)[51] and got[51]._pii_kinds == []


def test_masking_of_very_long_texts(spark):
    """A million characters of each pattern's alphabet: linear time and no deep stack."""
    bad = ["x@" + "a." * 500_000 + "1 9", "a" * 1_000_000 + "@", "@a." * 300_000, "1" * 1_000_000, "ab12" * 250_000, "AB12 " * 200_000, "1.2." * 250_000, "2020-01-" * 100_000, "+1 22 " * 150_000, "123-45-" * 140_000, "0f" * 500_000]
    rows = [(k, t) for k, t in enumerate(bad)] + [(99, "m" * 400_000 + "@site.example.com")]
    got = {r.doc_id: r.text for r in pii.mask(docs(spark, rows), "k").collect()}
    assert all(got[k] == t for k, t in rows if k < 99) and got[99].endswith("@pseudonym.invalid")


def test_masking_needs_a_key_and_keeps_clashing_columns(spark):
    with pytest.raises(ValueError):
        pii.secret_key(spark)
    df = docs(spark, [(1, "a.b@c.example.com")]).withColumns({c: F.lit(7) for c in ("_pii_hit", "_hit_0", "_gaps_0")})
    row = pii.mask(df, "k").first()
    assert row["_pii_hit"] == row["_hit_0"] == row["_gaps_0"] == 7 and row["_pii_kinds"] == ["email"]


def test_feistel_is_a_permutation(spark):
    a, b = F.lit(17).cast("long"), F.lit(43).cast("long")
    got = [r[0] for r in spark.range(17 * 43).select(pii.feistel("k", "t", F.col("id"), a, b)).collect()]
    assert sorted(got) == list(range(17 * 43)) and got != sorted(got)
    ds = [r[0] for r in spark.range(1000).select(pii.permute_digits("k", "t", F.lpad(F.col("id").cast("string"), 3, "0"))).collect()]
    assert sorted(ds) == [f"{k:03}" for k in range(1000)]


# --- mixing ---------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rate = (total - sum(capped.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if rate * weight[s] > 2 * sizes[s]]
        if not over:
            return capped | {s: rate * weight[s] for s in free}
        capped |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("leaf", [5, 2000])
def test_mixing(spark, leaf, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = random.Random(3)
    rows = [(k if k % 11 else None, rng.choice([0, 1, 5, 30]), rng.choice(["b", "a", "é", None, "c", "c", "c", "c"])) for k in range(700)] + [(9, 5, "c")] * 3
    df = spark.createDataFrame(rows, "doc_id long, n long, source string")
    out = [r.asDict() for r in mixing.mix(df.withColumn("extra", F.lit(1)), F.col("n"), leaf_rows=leaf).collect()]
    sizes = Counter()
    for _, n, s in rows:
        sizes[s] += n
    want = brute_targets(sizes)
    assert len(out) == len(rows) and Counter((r["doc_id"], r["n"], r["source"]) for r in out) == Counter(rows)
    for s in sizes:
        mine = [r for r in out if r["source"] == s]
        assert all(r["_mix_target"] == pytest.approx(want[s]) and r["_mix_source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["n"] * r["_mix_copies"] for r in mine) - want[s]) <= 30
    assert max(r["_mix_copies"] for r in out) <= 2
    again = [r.asDict() for r in mixing.mix(df.repartition(7).withColumn("extra", F.lit(1)), F.col("n"), leaf_rows=leaf).collect()]
    key = lambda r: (r["source"] or "", r["doc_id"] or -1, r["n"], r["_mix_copies"])
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert mixing.mix(df.limit(0), F.col("n")).count() == 0 and mixing.mix(df.where("n = 0"), F.col("n")).where("_mix_copies > 0").count() == 0


def test_mixing_of_null_ids_and_rows_alike(spark):
    """Half of the ids null and a third of all rows alike: bounded groups, every row counted, columns as they were."""
    rows = [(None if k % 2 else k, f"w{k} " * (k % 7 + 1), "a" if k % 3 else "b", 1) for k in range(3_000)] + [(None, "same words here", "a", 1)] * 1_500
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _mix_size int").withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    words = lambda t: len(t.split())
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += words(t)
    want = brute_targets(sizes)
    out = mixing.take(df)
    assert out.columns == df.columns
    got, taken, n = out.collect(), Counter(), Counter()
    for r in got:
        taken[r.source] += words(r.text)
        n[(r.doc_id, r.text, r.source)] += 1
    assert all(abs(taken[s] - want[s]) <= 10 for s in want) and all(r["_mix_size"] == 1 for r in got)
    most = Counter((d, t, s) for d, t, s, _ in rows)
    assert all(c <= 2 * most[k] for k, c in n.items())
    alike = mixing.mix(df.drop("m"), F.size(F.split("text", " "))).where("text = 'same words here'")
    assert alike.count() == 1_500 and alike.agg(F.max("_mix_copies") - F.min("_mix_copies")).first()[0] <= 1


def test_pivot_keeps_words_and_is_fair():
    size, p = np.array([3.0, 5, 2, 9, 4]), np.array([0.2, 0.5, 0.7, 0.3, 0.9])
    total = np.zeros(5)
    for k in range(4000):
        q = mixing.pivot(size, p, np.random.default_rng(k))
        assert (q * size).sum() == pytest.approx((p * size).sum()) and ((q > 0) & (q < 1)).sum() <= 1
        total += q
    assert np.allclose(total / 4000, p, atol=0.03)


# --- near duplicates, search, fingerprints ---------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_fingerprints(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("ÀB a1 é\x0b Ok.").strip() or "\t" for _ in range(rng.randint(0, 30))) for _ in range(50)] + [t for _, t in ODD]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert spark.range(1).select(F.xxhash64(F.lit("ab c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("ab c", 42)


def test_masks_cover_every_pair():
    masks = simhash.covering_masks(3)
    rng = random.Random(7)
    assert len(masks) == 15
    for _ in range(5000):
        diff = sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 3))})
        assert any(diff & m == 0 for m in masks)


def brute_components(fps):
    up = {i: i for i in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if bin(fps[a] ^ fps[b]).count("1") <= 3:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("chunk", [3, 2048])
def test_near_links_and_components(spark, chunk):
    rng = random.Random(8)
    fps, at = {}, rng.getrandbits(64)
    for k in range(300):  # chains, in which each is near the one before, and dense groups
        at = rng.getrandbits(64) if k % 60 == 0 else at ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        fps[1000 - k] = at if k % 2 else at & ~7
    distinct = {}
    for i, f in fps.items():
        distinct[f] = min(i, distinct.get(f, i))
    df = spark.createDataFrame([(simhash._signed(f), i) for f, i in distinct.items()], "fp long, rep long")
    got = {r.node: r.component for r in simhash.components(simhash.near_links(df, chunk=chunk)).collect()}
    want = brute_components({i: f for f, i in distinct.items()})
    assert {i: got.get(i, i) for i in want} == want


def test_near_duplicates_of_odd_rows(spark):
    text = "the quick brown fox jumps over the lazy dog and then some more words follow here " * 20
    rows = [*ODD, (20, text), (21, text), (21, text), (22, text + "end"), (23, "quite another text of several words in a row")]
    df = docs(spark, rows, extra=True)
    got = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect())
    fps = {}
    for d, t in rows:
        if d is not None:
            fps[d] = plain_fingerprint(t)
    want = brute_components(fps)
    assert got == Counter((d, want.get(d)) for d, _ in rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter([*set(want.values()), None])
    assert simhash.near_duplicates(docs(spark, [])).count() == 0 and simhash.keep_one(docs(spark, [])).count() == 0


def test_kept_rows_of_clashing_names_and_repeated_ids(spark):
    df = docs(spark, [(1, "b"), (1, "a"), (1, "a"), (2, None), (2, ""), (None, "x"), (None, "x")]).withColumns({c: F.lit(3) for c in ("_kept", "_place", "_rows", "_kept_0", "component_id")})
    out = simhash.keep_first(df, spark.createDataFrame([(1, 1)] * 3 + [(2, 2)] * 2, "doc_id long, component_id long"))
    assert out.columns == df.columns and Counter((r.doc_id, r.text) for r in out.collect()) == Counter([(1, "a"), (2, ""), (None, "x"), (None, "x")])


@pytest.mark.parametrize("chunk", [300, 400_000])
def test_pipeline_drops_near_copies(spark, chunk, monkeypatch):
    import corpus_pipeline
    from quarterdeck.llm import similar

    monkeypatch.setattr(similar, "CHUNK_SHINGLES", chunk)
    rng = random.Random(14)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows = [*ODD]
    for k in range(40):
        base = text(200)
        rows.append((100 * k + 100, " ".join(base)))
        for e, edits in enumerate([1, 2, 3, 4, 10, 25]):  # words replaced far apart
            edited = list(base)
            for at in range(edits):
                edited[at * 8 + 3] = f"new{k}-{e}-{at}"
            rows.append((100 * k + 101 + e, " ".join(edited)))
    shingle = lambda t: {tuple(w[i : i + 5]) for w in [t.split()] for i in range(max(1, len(w) - 4))}
    sets = {d: shingle(t) for d, t in rows if d is not None and d >= 100}
    want, up = set(), {d: d for d in sets}
    for a in sorted(sets):
        for b in (b for b in sets if a < b < a + 100 and a // 100 == b // 100):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((up[a], up[b]))
                up = {d: x if r == y else r for d, r in up.items()}
    want = set(up.values())
    assert len(want) == 120  # of each seven the first with its four nearest, and the two far ones
    df = docs(spark, rows, extra=True)
    out = corpus_pipeline.near_dedup(spark, df, "")
    got = [r.doc_id for r in out.collect()]
    assert out.columns == df.columns and Counter(got) == Counter([*want, 0, 3, 4, 5, 7, None])
    assert corpus_pipeline.near_dedup(spark, docs(spark, []), "").count() == 0


def test_top_k(spark):
    """Against brute force and the query's SQL, with null, repeated and empty rows, of which each takes part by itself."""
    rng = np.random.default_rng(9)
    v = [(k, [float(x) for x in rng.normal(size=6).round(1)]) for k in range(200)]
    v += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (None, [0.0] * 6), (None, [3.0] * 6), (20, [9.0] * 6), (20, [9.0] * 6), (40, v[40][1]), (7, v[7][1]), (510, []), (520, []), (530, [1.0, 2.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    ints = topk.integer_vectors(df)
    rows = [(i, np.floor(64 * np.array(x, np.float32).astype(float)).astype(int)) for i, x in v if x is not None and None not in x and np.isfinite(x).all()]
    assert len(rows) == ints.count() == ints.select("vec_id", "row").distinct().count() == 209

    def brute(k):
        out = []
        for q, (query, w) in enumerate(rows):
            if query is not None and query % 20 == 0:
                score = lambda x: int(sum(a * b for a, b in zip(w, x)))
                best = sorted((-score(x), i is None, i or 0) for c, (i, x) in enumerate(rows) if c != q)[:k]
                out += [(query, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(best)]
        return sorted(out, key=str)

    for block in (50, 3, None):
        got = [tuple(r) for r in topk.top_k(ints, ints.where("vec_id % 20 = 0"), k=7, block=block).collect()]
        assert sorted(got, key=str) == brute(7)
    embeddings = pa.table({"vec_id": pa.array([i for i, _ in v], pa.int64()), "embedding": pa.array([x for _, x in v], pa.list_(pa.float32()))})  # noqa: F841
    assert sorted(duckdb.sql(topk.OP8_SQL).fetchall(), key=str) == brute(20)
    few = ints.where("vec_id < 3")
    assert topk.top_k(few, few.where("vec_id = 0")).count() == 2 and topk.top_k(ints.limit(0), ints.limit(0)).count() == 0


def test_search_stops_on_proof_only():
    rng = np.random.default_rng(10)
    for scale in (30, 10**7):
        x = (rng.normal(size=(3000, 8)) * scale).astype(np.int64)
        x[:40] *= 5
        index = topk.ImpactIndex(np.arange(3000), x)
        for w in [*x[:20], np.zeros(8, np.int64), -x[0]]:
            ids, score = index.search(w, 10)
            exact = x @ w
            order = np.lexsort((np.arange(3000), -exact))[:10]
            assert ids.tolist() == order.tolist() and score.tolist() == exact[order].tolist()


def following_order(spark, rows):
    """By descending id, nulls last, and within one id by the hash of the text."""
    h = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), h[r[1] or ""]))


@pytest.mark.parametrize("ids", ["outlier", "null and repeated", "clusters"])
def test_neighbours_of_uneven_ids(spark, ids, monkeypatch):
    """Buckets stay even, and every text has the next one's beginning."""
    rng = random.Random(15)
    make = {"outlier": lambda k: 10**15 if k == 7 else k, "null and repeated": lambda k: None if k % 3 == 0 else 5 if k % 3 == 1 else k, "clusters": lambda k: (k % 3) * 10**12 - 10**12 + k}
    rows = [(make[ids](k), f"{k} " + "x" * rng.randint(0, 40)) for k in range(1_500)]
    monkeypatch.setattr(weighted_minhash, "BUCKET_ROWS", 16)
    monkeypatch.setattr(weighted_minhash, "RANGES", 40)
    df = docs(spark, rows)
    sizes = [r["count"] for r in weighted_minhash.dealt_to_buckets(df).groupBy("bucket").count().collect()]
    assert max(sizes) <= 60 and len(sizes) > 60
    order = following_order(spark, rows)
    want = Counter()
    for k, (d, t) in enumerate(order):
        h, following = len(t) // 2, order[(k + 1) % len(order)][1]
        want[(d, hashlib.sha256((t[: len(t) - h] + following[:h]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in weighted_minhash.edited_fingerprints(df).select("doc_id", "edited_sha256").collect()) == want


def test_weighted_sampling(spark):
    rows = [*ODD[:4], (10, "a b c d e f g h i j k l " * 9), (11, "a b c d e f g h i j k l " * 9), (12, "z " * 40), (12, "z " * 40)]
    out = weighted_minhash.edited_fingerprints(docs(spark, rows))
    got = out.collect()
    order = following_order(spark, rows)
    want = Counter()
    for k, (d, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        want[(d, len(t), hashlib.sha256((t[: len(t) - h] + following[:h]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    mark = {r.doc_id: r.fingerprint for r in got}
    assert mark[10] == mark[11] and mark[0] == mark[1] == "" and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert {r.doc_id: r.near_next for r in got}[11] == 1.0
    assert weighted_minhash.edited_fingerprints(docs(spark, [])).count() == 0


def plain_signature(weights):
    """Every sample's number and 16 bits of its winner, from the draws of all terms (hash: weight)."""
    of = lambda kind, v, seed: xxhash.xxh64_intdigest(struct.pack(kind, v), seed=seed)
    out = []
    for s in range(64):
        best = None
        for h, w in weights.items():
            x = of("<i", s, of("<q", h, 42))
            z = of("<Q", x, 42)
            u1, u2, v1, v2 = [((x >> 16 * k & 65535) + 0.5) / 65536 for k in range(4)]
            b, r, c = ((z >> 48) + 0.5) / 65536, -math.log(u1 * u2), -math.log(v1 * v2)
            t = math.floor(math.log(w) / r + b)
            a = c / (math.exp(r * (t - b)) * math.exp(r))
            best = min(best or (math.inf, 0), (a, z + t & 65535))
        out.append(f"{s:02x}{best[1]:04x}")
    return out


def test_draws_are_those_of_brute_force(spark):
    """Signatures of texts, and of texts with their edits, are those of all draws; 1 or 2,000 terms, single or heavy."""
    rng = random.Random(21)
    sides = []
    for n in (1, 7, 60, 2_000):
        first = {rng.getrandbits(63): rng.choice([1, 1, 1, 2, 9, 400 if n < 2_000 else 3]) for _ in range(n)}
        second = {h: w if rng.random() < 0.6 else w + 1 for h, w in first.items() if rng.random() < 0.7} | {rng.getrandbits(63): 1 for _ in range(n // 2)}
        sides += [(n, first, second)]
    rows = [(n, e, sum(ws.values()), h) for n, *both in sides for e, ws in enumerate(both) for h, w in ws.items() for _ in range(w)]
    terms = spark.createDataFrame(rows, "k int, edit int, total long, h long")
    own = {(r.k, r.edit): r.signature for r in weighted_minhash.signatures(terms, ["k", "edit"]).collect()}
    want = {(n, e): plain_signature(ws) for n, *both in sides for e, ws in enumerate(both) if ws}
    assert own == want
    pairs = {r.k: (r.mark, r.edited_mark) for r in weighted_minhash.paired_signatures(terms, ["k"]).collect()}
    assert pairs == {n: (want.get((n, 0)), want.get((n, 1))) for n, *_ in sides}


def test_sampling_rate_is_the_generalised_jaccard(spark):
    rng = np.random.default_rng(11)
    a, b = rng.integers(0, 6, 40), rng.integers(0, 6, 40)
    terms = [(s, k, int(t)) for s in range(300) for k, w in enumerate((a, b)) for t, n in enumerate(w) for _ in range(n)]
    df = spark.createDataFrame(terms, "trial int, side int, t int").select("trial", "side", F.xxhash64("trial", "t").alias("h"))
    marks = weighted_minhash.signatures(df, ["trial", "side"], samples=1).groupBy("trial").agg(*[F.max(F.when(F.col("side") == k, F.col("signature"))).alias(f"s{k}") for k in (0, 1)])
    rate = marks.select(F.avg(weighted_minhash.likeness(F.col("s0"), F.col("s1")))).first()[0]
    assert rate == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.08)


def test_sampling_rate_at_skewed_counts(spark):
    """A passage repeated many times counts with its whole weight, whatever the few other terms say."""
    sides = [("heavy shared", (10_000, "h"), (10_000, "h")), ("heavy apart", (3_000, "p"), (3_000, "q")), ("heavier", (2_000, "h"), (1_000, "h"))]
    terms, want = [], {}
    for trial, *two in sides:
        singles = [f"s{k}" if trial == "heavy apart" else None for k in range(300)]
        texts = [Counter({name: n}) + Counter(s or f"{side}{k}" for k, s in enumerate(singles)) for side, (n, name) in enumerate(two)]
        terms += [(trial, side, t) for side, c in enumerate(texts) for t in c.elements()]
        want[trial] = sum((texts[0] & texts[1]).values()) / sum((texts[0] | texts[1]).values())
    df = spark.createDataFrame(terms, "trial string, side int, t string").select("trial", "side", F.xxhash64("t").alias("h"))
    marks = weighted_minhash.signatures(df, ["trial", "side"]).groupBy("trial").agg(*[F.max(F.when(F.col("side") == k, F.col("signature"))).alias(f"s{k}") for k in (0, 1)])
    got = {r[0]: r[1] for r in marks.select("trial", weighted_minhash.likeness(F.col("s0"), F.col("s1"))).collect()}
    assert all(got[t] == pytest.approx(w, abs=4 * (w * (1 - w) / 64) ** 0.5 + 0.01) for t, w in want.items()), (got, want)


# --- pipeline -------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "sentencepiece"]
    rng = random.Random(12)
    words = [f"w{k}" for k in range(400)]
    text = lambda: " ".join(rng.choice(words) for _ in range(60))
    rows = [(k, text() + (". vile vile. " if k % 10 == 0 else "") + (" a.b@c.example.com" if k % 7 == 0 else ""), "en", f"s{k % 3}", 5) for k in range(200)]
    rows += [(300, rows[1][1], "en", "s0", 5), (301, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k % 10 == 0)) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    df, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        assert name == "sentencepiece" or out.columns == df.columns
        out.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        seen[name] = df.collect()
    assert {r.doc_id for r in seen["toxicity"]} == {d for d, *_ in rows if d >= 200 or d % 10}
    assert {r.doc_id for r in seen["near_dedup"]} == {r.doc_id for r in seen["toxicity"]} - {300}
    assert not any("@c.example" in (r.text or "") for r in seen["pii"]) and all(r.n_chars == (len(r.text) if r.text is not None else None) for r in seen["pii"])
    n = lambda rs: sum(len((r.text or "").split()) for r in rs)
    assert abs(n(seen["mixing"]) - 1.5 * n(seen["pii"])) < 200 and all(r.round_trip for r in seen["sentencepiece"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter((r.doc_id, r.ids_sha256) for r in whole.collect()) == Counter((r.doc_id, r.ids_sha256) for r in seen["sentencepiece"])


def test_near_copies_are_found_by_simhash_too(spark):
    from quarterdeck.llm import similar

    near, far = 0b111 << 20, (1 << 40) - 1
    rows = [(1, 5, near, [1]), (2, 5, 0, [2]), (3, 6, near, [3]), (4, 5, far, [2]), (5, 5, near | 1 << 50, [5]), (6, 0, 0, []), (7, 5, ~far, [7])]
    links = similar.candidates(spark.createDataFrame(rows, "rep long, n long, fp long, bands array<long>"))
    assert {(r["node"], r["component"]) for r in simhash.components(links).collect()} == {(2, 1), (3, 1), (4, 1), (5, 1)}
    own = similar.sketches(spark.createDataFrame([(1, "One two three four five six"), (2, "")], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in own} == {1: simhash.fingerprint("one two three four five six", 5), 2: 0}
