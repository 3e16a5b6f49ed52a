"""Operators on small tables: brute force, round trips, nulls, repeats, empty tables, columns with clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tailmap.llm import exact_dedup, langid, mixing, pieces, pii, secrets, sstable, token_output, topk, url_filter

DOCS = "doc_id bigint, text string, lang string, source string"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOCS)


# Exact dedup


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("bits", [64, 1])
def test_exact_groups(spark, bits):
    long = "Some words, and more. " * 400
    rows = [(i, t, None, None) for i, t in enumerate([long, long.upper(), long + "x", "É", "é", "", None, "a", "A", "b", "b", "b"])] + [(None, "b", None, None), (3, "É", None, None)]
    got = exact_dedup.exact_groups(docs_of(spark, rows).withColumn("recipe", F.lit(1)), id_bits=bits).collect()
    by = {}
    for i, t, *_ in rows:
        by.setdefault(lowered(t), []).append(i)
    want = []
    for i, t, *_ in rows:
        group = by[lowered(t)]
        keep = max((x for x in group if x is not None), default=None)
        want.append((str(i), str(keep), len(group), i == keep, hashlib.sha256(lowered(t).encode()).hexdigest()))
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == sorted(want)
    assert exact_dedup.exact_groups(docs_of(spark, [])).count() == 0


def test_chunks_of_every_script(spark):
    rng = random.Random(3)
    letters = {"latin": "abcdefghijklmnopqrstuvwxyz  ", "cyrillic": "абвгдежзиклмнопрстуфхцчшщыэюя  ", "han": [chr(0x4E00 + i) for i in range(300)], "emoji": ["🙂", "🙃", "😀", "😁"]}
    shared = {k: "".join(rng.choice(v) for _ in range(16_000)) for k, v in letters.items()}
    rows = [(i, "x" * (37 * i) + t, None, None) for i, t in enumerate([*shared.values(), *shared.values()])] + [(50, "ab" * 30_000, None, None), (51, "é" * 30_000, None, None)]
    got = {r.doc_id: r for r in exact_dedup.recipes(docs_of(spark, rows)).collect()}
    for i in range(4):
        assert len(got[i].ids) >= 10
        # The same passage behind another beginning: most chunks are the same.
        assert len(set(got[i].ids) & set(got[i + 4].ids)) >= len(got[i].ids) // (2 if i < 3 else 4)
    chunks = docs_of(spark, rows).select(F.explode(F.regexp_extract_all(F.col("text"), F.lit(exact_dedup.chunk_pattern()), F.lit(0))).alias("c"), "text")
    assert chunks.agg(F.max(F.length("c"))).first()[0] <= exact_dedup.CHUNK_MAX
    whole = docs_of(spark, rows).select("text", F.array_join(F.regexp_extract_all(F.col("text"), F.lit(exact_dedup.chunk_pattern()), F.lit(0)), "").alias("again"))
    assert whole.where("text <> again").isEmpty()


# Language ID


def test_languages(spark):
    rng = random.Random(2)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "αβγδε"}
    rows = [(i, " ".join("".join(rng.choice(alphabets[g]) for _ in range(5)) for _ in range(rng.randint(5, 60))), g, None) for i in range(240) for g in [rng.choice("abc") * 2]]
    rows += [(900, None, "aa", None), (901, "12 !", "bb", None), (None, "abcde abc", None, None), (902, "abc" * 30_000, None, None)]
    got = {r.doc_id: r for r in langid.identify(docs_of(spark, rows).withColumn("score", F.lit("x"))).collect()}
    assert len(got) == len(rows)
    held = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert all(got[r[0]].held_out for r in held) and not got[None].held_out
    judged = [r for r in held if r[0] < 900]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in judged]) > 0.95
    assert (got[900].lang_pred, got[900].score, got[901].lang_pred) == ("und", 0.0, "und")
    assert all(0 <= r.score <= 1 for r in got.values())
    none = docs_of(spark, [(1, "abc", None, None)])
    assert langid.identify(none).first().lang_pred == "und" and langid.identify(none.limit(0)).count() == 0
    assert {r.doc_id for r in langid.keep_identified(docs_of(spark, rows)).collect()} >= {r[0] for r in judged} and langid.keep_identified(none).count() == 1


def test_profiles_are_sums_of_bound_letters():
    keys = np.concatenate(list(langid.gram_keys("ab", 3)))
    a, b, s = (langid.letter_vector(ord(c), 64).astype(int) for c in "ab ")
    want = np.roll(s, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * s
    assert (langid.ngram_vectors(keys, 64, 3).astype(int).sum(axis=0) == want).all()
    text = "Hello, wörld! 12 abc  Ünd Σ" * 40
    for size in (1, 2, 5, 64):
        assert (np.concatenate(list(langid.gram_keys(text, 3, size))) == np.concatenate(list(langid.gram_keys(text, 3)))).all()


def plain_profile(text, dimensions=1024, n=3):
    """The bundle of a text, letter by letter."""
    if not any(c.isalpha() for c in text or ""):
        return np.zeros(dimensions), 0
    # Behind a letter one character that is none stands as a space, and there is a space at either end.
    out, before = [" "], False
    for c in text:
        if c.isalpha():
            out.append(c.lower() if len(c.lower()) == 1 else c)
        elif before:
            out.append(" ")
        before = c.isalpha()
    out.append(" ")
    total, grams = np.zeros(dimensions), 0
    for at in range(len(out) - n + 1):
        v = np.ones(dimensions)
        for j, c in enumerate(out[at : at + n]):
            v = v * np.roll(langid.letter_vector(ord(c), dimensions).astype(float), n - 1 - j)
        total, grams = total + v, grams + 1
    return total, grams


def test_languages_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.substring("text", 1, 300).alias("text"), "lang", "source")
    rows = docs.collect()
    profiles = {r.doc_id: plain_profile(r.text) for r in rows}
    sums = {}
    for r in rows:
        if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            v, n = profiles[r.doc_id]
            sums[r.lang] = sums.get(r.lang, 0) + v / max(1, n)
    names = sorted(sums)
    unit = np.array([sums[x] / np.linalg.norm(sums[x]) for x in names])
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    for r in rows:
        v, n = profiles[r.doc_id]
        if not n:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        cosine = unit @ v / np.linalg.norm(v)
        assert abs(got[r.doc_id].score - max(0.0, cosine.max())) < 1e-4
        if np.sort(cosine)[-1] - np.sort(cosine)[-2] > 1e-4:
            assert got[r.doc_id].lang_pred == names[int(cosine.argmax())]


def test_equal_cosines_go_to_the_first_language(spark):
    rows = [(i, "abc abd", lang, None) for i, lang in enumerate(["zz", "bb", "mm"] * 8)]
    assert {r.lang_pred for r in langid.identify(docs_of(spark, rows)).collect()} == {"bb"}


@pytest.mark.parametrize("ids", [[None] * 50, [3, 5, 6, 8] * 13, list(range(50))])
def test_sample_is_bounded_and_not_empty(spark, ids):
    rows = [(i, f"text {k}", "aa", None) for k, i in enumerate(ids)] + [(7, "again", "aa", None)] * 5
    sample = langid.sample_of(docs_of(spark, rows).select("doc_id", "text", "lang"), 10)
    assert sample.count() == 10 and langid.sample_of(docs_of(spark, rows), 1000).count() == len(ids) + 1
    assert langid.sample_of(docs_of(spark, []), 10).count() == 0


def test_clashing_names_of_judgements(spark):
    rows = docs_of(spark, [(i, f"abc abd {i}", "aa", None) for i in range(20)]).withColumns({"_judged": F.lit("mine"), "_said": F.lit("too")})
    kept = langid.keep_identified(rows)
    assert kept.columns == rows.columns and {(r._judged, r._said) for r in kept.collect()} == {("mine", "too")}
    assert {r._said for r in langid.predict(rows, *langid.prototypes(rows)).collect()} == {"too"}


# SentencePiece


def sp_docs():
    rng = random.Random(1)
    rows = ["", None, " ", "  a", "a  ", " x▁y", "🙂\x00é", "▁▁▁é", "a" * 700, " " * 90, "Ａﬁ z", "the" * 40, "\n\n\ta", "Hello world, the end."]
    rows += ["".join(rng.choice("abthein  ▁éç🙂\n") for _ in range(rng.randint(1, 150))) for _ in range(150)]
    return [(i, t, None, None) for i, t in enumerate(rows)] + [(3, "  a", None, None), (None, "null id", None, None)]


def test_encoding_is_the_librarys(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Model.load(path)
    rows = sp_docs()
    got = pieces.encode_decode(docs_of(spark, rows).withColumn("ids", F.lit(0)), model, common=40).collect()
    want = [(str(i), sp.encode(t or ""), zlib.crc32((t or "").replace("▁", " ").encode())) for i, t, *_ in rows]
    assert sorted((str(r.doc_id), list(r.ids), r.decoded_crc32) for r in got) == sorted(want)
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert pieces.encode_decode(docs_of(spark, []), model).count() == 0


def test_decoding_odd_ids(spark):
    model = pieces.Model.of([("▁a", 3, 0.0)], list(range(10, 266)), 0)
    rows = spark.createDataFrame([([3, 3],), ([10 + 0xC3],), (None,), ([999, -1, None, 3],), ([],)], "ids array<int>")
    assert [r.text for r in pieces.decode(rows, model).collect()] == ["a a", "�", None, "a", ""]


def test_viterbi_is_the_best_path(spark):
    rng = random.Random(6)
    made = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)} | {"▁", "▁a", "a", "b"}
    # Scores of few values: many pieces have the same.  Texts on both sides of the length that the fold takes.
    model = pieces.Model.of([(p, 10 + i, -rng.randint(1, 8) / 2) for i, p in enumerate(sorted(made))], list(range(1000, 1256)), 0)
    score = {p: (s, i) for p, i, s in model.pieces}
    worst = min(s for s, _ in score.values()) - 10
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["".join(rng.choice("abc") for _ in range(n)) for n in (58, 59, 60, 61, 200)]

    def best(text):
        w = " " + text
        top = [0.0] + [-1e18] * len(w)
        for e in range(1, len(w) + 1):
            for s in range(e):
                one = score.get(w[s:e], (worst, 0) if e - s == 1 else None)
                if one:
                    top[e] = max(top[e], top[s] + one[0])
        return top[-1]

    value = {i: s for s, i in score.values()}
    got = pieces.encode(docs_of(spark, [(i, t, None, None) for i, t in enumerate(texts)]), model, fold="viterbi").collect()
    for r in got:
        assert sum(value.get(i, worst) for i in r.ids) == pytest.approx(best(texts[r.doc_id]))
    # A segment gets the same path from the fold and from a worker.
    for text in texts:
        if 0 < len(text) < 60:
            ids = {tuple(r.ids) for r in got if texts[r.doc_id] == text}
            assert ids == {tuple(pieces.best_path(" " + text, model, score))} or "d" in text


# Secrets


def test_secret_spans():
    rng = random.Random(1)
    token = "".join(rng.sample("abcdefghijklmnopqrstuvwxyzGHIJKLMN0123456789", 40))
    text = f"é api_key = '{'k' * 12}1' x AKIA{'A' * 14} {'ab12' * 4} {token} 123e4567-e89b-12d3-a456-426614174000"
    kinds = [(k, text[s:e]) for s, e, k in secrets.spans_of(text)]
    assert ("assign", f"api_key = '{'k' * 12}1") in kinds and ("access", "AKIA" + "A" * 14) in kinds and ("hex", "ab12" * 4) in kinds and ("entropy", token) in kinds
    assert not any("123e4567" in t for _, t in kinds)
    assert secrets.spans_of("token=" + "a" * 11) == [] and secrets.spans_of("") == []


def test_windows_are_counted_right():
    import math
    from collections import Counter

    rng, w = random.Random(3), secrets.WINDOW
    text = "".join(rng.choice("abcdefgh" if rng.random() < 0.5 else "abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(400))
    for bits in (3.2, 3.6, 4.0):
        want = set()
        for i in range(len(text) - w + 1):
            h = -sum(n / w * math.log2(n / w) for n in Counter(text[i : i + w]).values())
            if h >= bits - 1e-9:
                want |= set(range(i, i + w))
        assert {i for s, e in secrets.hot_windows(text, bits) for i in range(s, e)} == want


def test_secret_table(spark):
    rows = docs_of(spark, [(1, "token=" + "x1" * 10, None, None), (1, None, None, None), (None, "a" * 300_000, None, None)])
    got = sorted((str(r.doc_id), r.n_assign, r.base_sha256) for r in secrets.secret_digests(rows.withColumn("found", F.lit(1))).collect())
    assert got == sorted([("1", 1, hashlib.sha256(b"assign:0:26").hexdigest()), ("1", 0, hashlib.sha256(b"").hexdigest()), ("None", 0, got[-1][2])])
    assert secrets.redact_secrets(rows).first().text == "[SECRET]" and secrets.secret_digests(rows.limit(0)).count() == 0


def brute_secrets(text):
    """All windows counted anew, all spans compared with all others."""
    import math
    from collections import Counter

    base = [(*m.span(), "assign") for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    base += [(*m.span(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(*m.span(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    out = list(base)
    for chars, bits in ((r"[0-9A-Fa-f]+", 3.0), (r"[A-Za-z0-9+/_=-]+", 4.0)):
        new = []
        for m in re.finditer(chars, text):
            run = m[0]
            if not re.search(r"[0-9]", run) or not re.search(r"[A-Za-z]", run) or re.fullmatch(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", run):
                continue
            fake = set()
            for p in re.finditer(r"(?i)example|placeholder|changeme|your[_-]|xxxx|deadbeef|0123456789abcdef", run):
                fake |= set(range(*p.span()))
            hot = []
            for i in range(len(run) - 19):
                counts = Counter(run[i : i + 20])
                if not fake & set(range(i, i + 20)) and -sum(n / 20 * math.log2(n / 20) for n in counts.values()) >= bits - 1e-9:
                    if hot and m.start() + i <= hot[-1][1] and not fake & set(range(hot[-1][0] - m.start(), i + 20)):
                        hot[-1] = (hot[-1][0], m.start() + i + 20)
                    else:
                        hot.append((m.start() + i, m.start() + i + 20))
            new += [h for h in hot if not any(s <= h[0] and h[1] <= e for s, e, _ in out)]
        out += [(s, e, "entropy") for s, e in new]
    return sorted(out, key=lambda x: (x[0], secrets.KINDS.index(x[2]), x[1]))


def test_secrets_are_brute_force():
    rng, letters = random.Random(5), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    word = lambda n, chars=letters: "".join(rng.choice(chars) for _ in range(n))
    made = [lambda: "token=" + word(rng.randint(8, 30)), lambda: "Api_Key: '" + word(20) + "'", lambda: "AKIA" + word(rng.randint(10, 18), letters[26:]), lambda: word(rng.randint(10, 40), "0123456789abcdef"), lambda: word(rng.randint(15, 60))]
    made += [lambda: rng.choice(["example", "xxxx", "your_", "/", "-", "deadbeef", "é", "🙂", " ", "123e4567-e89b-12d3-a456-426614174000", "password"]), lambda: word(40, "ab1")]
    for _ in range(500):
        text = "".join(rng.choice(made)() + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 8)))
        assert secrets.spans_of(text) == brute_secrets(text), text
    two = word(30) + "xxxx" + word(30)
    assert [k for *_, k in secrets.spans_of("A1" + two)] == ["entropy", "entropy"]


def test_secrets_of_a_long_text():
    import time

    rng, letters = random.Random(6), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    part = " ".join("token=" + "".join(rng.choice(letters) for _ in range(24)) + " " + "".join(rng.choice(letters) for _ in range(40)) for _ in range(1000)) + "\n"
    began, once = time.time(), secrets.spans_of(part)
    text = part * 28
    assert len(text) > 2_000_000
    assert secrets.spans_of(text) == [(s + i * len(part), e + i * len(part), k) for i in range(28) for s, e, k in once]
    assert time.time() - began < 30


# Personal data


def brute_pii(t):
    out = {"email": [], "ip": [], "card": [], "phone": []}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out["phone"].append(m.span())
    return out


def test_base_spans(spark):
    rng = random.Random(9)
    bits = ["a@b.co", "x.y@z", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123456", "+1 2", "é", " ", "-", ".", "@", "+", "7", "0001.2.3.4", "🙂"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(400)] + ["", None, "9" * 50_000, "a." * 20_000 + "@"]
    got = pii.pii_digests(docs_of(spark, [(i, t, None, None) for i, t in enumerate(texts)]).withColumn("spans", F.lit(1))).collect()
    assert len(got) == len(texts)
    for r in got:
        found = brute_pii(texts[r.doc_id] or "")
        base = ",".join(f"{k}:{s}:{e}" for k, v in found.items() for s, e in v)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, found.values())), texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), texts[r.doc_id]


def test_disclosing_terms(spark):
    rows = [(i, "report by zanzibar office of ann@x.org today", None, None) for i in range(5)] + [(10 + i, f"report by other office number {i} today", None, None) for i in range(60)]
    got = {r.doc_id: r.spans for r in pii.pii_digests(docs_of(spark, rows)).collect()}
    assert "term:10:18" in got[0] and "term" not in got[10]
    clean = {r.doc_id: r.text for r in pii.sanitise(docs_of(spark, rows)).collect()}
    assert "zanzibar" not in clean[0] and "ann@" not in clean[0] and clean[10] == rows[5][1]


def brute_terms(rows, near=80, least=3, generalise=0.8):
    """For each row the set of term spans, all counts made anew."""
    import math
    from collections import Counter

    import regex

    term = regex.compile(r"[\p{L}\p{N}]{3,}")
    found = [brute_pii(t or "") for _, t in rows]
    holders, both, sites = {}, {}, []
    for at, ((i, t), spans) in enumerate(zip(rows, found, strict=True)):
        t = t or ""
        for kind, places in spans.items():
            for s, e in places:
                hit = t[s:e]
                entity = kind + ":" + (hit.lower() if kind == "email" else hit if kind == "ip" else re.sub(r"[ ().+-]", "", hit))
                holders.setdefault(entity, set()).add((i, t))
                cut = max(0, s - near)
                left = (m.start() if (m := re.search(r"(?a)\s", t[cut:s])) else s - cut) if cut else 0
                right = t[e : e + near]
                if len(right) == near:
                    right = right[: max((m.end() for m in re.finditer(r"(?a)\s", right)), default=0)]
                for m in [*term.finditer(t[:s], cut + left), *term.finditer(t[: e + len(right)], e)]:
                    if not any(m.start() < f and m.end() > b for p in spans.values() for b, f in p):
                        both.setdefault((entity, m[0].lower()), set()).add((i, t))
                        sites.append((at, entity, m[0].lower(), m.span()))
    # Rows that repeat a document count once.
    distinct = {(i, t or "") for i, t in rows}
    documents = Counter(w for _, t in distinct for w in set(term.findall(t.lower())))
    n, out = len(distinct), [set() for _ in rows]
    for at, entity, word, span in sites:
        c, e = len(both[entity, word]), len(holders[entity])
        if c >= least and e < n and math.log(n * c / (e * documents[word])) / math.log(n / e) >= generalise:
            out[at].add(span)
    return out


def test_terms_are_brute_force(spark):
    rng = random.Random(4)
    people = [("ann@x.org", "zanzibar"), ("10.0.0.7", "Quokka"), ("+49 30 123456", "élan7"), ("bo@y.org", "bo@y.orgish")]
    words = ["report", "office", "by", "today", "αβγ", "x1", "and", "of the", "4111111111111111", "\n"]
    rows = []
    for i in range(150):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        for value, word in rng.sample(people, rng.randint(0, 2)):
            at = rng.randint(0, len(parts))
            parts[at:at] = rng.sample([value, word, rng.choice(words)], 3)
        rows.append((i, rng.choice([" ", "  ", "-"]).join(parts)))
    rows += [rows[3], rows[4], (None, rows[5][1]), (200, None), (201, "")] + [rows[7]] * 30
    want = sorted((str(i), ",".join(f"term:{s}:{e}" for s, e in sorted(t))) for (i, _), t in zip(rows, brute_terms(rows), strict=True))
    got = sorted((str(r.doc_id), ",".join(x for x in r.spans.split(",") if x.startswith("term"))) for r in pii.pii_digests(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == want and sum(1 for _, t in want if t) > 20


def test_words_are_counted_before_any_join(spark):
    rows = [(i, "report by zanzibar office of ann@x.org today") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    met = []
    counts = pii._document_counts(docs, docs.limit(0), id_col="doc_id", text_col="text")
    for line in counts._jdf.queryExecution().optimizedPlan().toString().splitlines():
        met += [x for x in ("Aggregate", "Join", "Generate") if x in line]
    assert met == ["Aggregate", "Generate"] and dict(counts.collect())["zanzibar"] == 50


def test_personal_data_of_nothing_and_of_clashing_names(spark):
    assert pii.pii_digests(docs_of(spark, [])).count() == 0 and pii.sanitise(docs_of(spark, [])).count() == 0
    named = docs_of(spark, [(1, "to ann@x.org", None, None)]).withColumns({"_p_id": F.lit(1), "_P_KEY": F.lit(2), "_p_cuts": F.lit(3)})
    row = pii.sanitise(named).first()
    assert (row.text, row._p_id, row._p_cuts) == ("to [EMAIL]", 1, 3)


def test_personal_data_in_a_long_text(spark):
    import time

    part = " ".join(f"user{i}@ex{i}.org at 10.{i % 250}.3.{i % 200} word{i % 7} +49 (30) {100000 + i}" for i in range(1000)) + "\n"
    text, began = part * 40, time.time()
    assert len(text) > 2_000_000
    rows = spark.createDataFrame([(1, text), (2, "word3 ann@x.org")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.pii_digests(rows).collect()}
    found = brute_pii(text)
    assert got[1].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, v in found.items() for s, e in v).encode()).hexdigest()
    clean = {r.doc_id: r.text for r in pii.sanitise(rows).collect()}
    assert not any(brute_pii(clean[1])[k] for k in ("email", "ip", "phone")) and clean[1].count("[EMAIL]") == 40_000
    assert time.time() - began < 240


# URLs


def test_verdicts(spark):
    canonical = lambda u: f"<html><LINK rel='canonical' href=\"{u}\"></html>"
    rows = [
        (1, "https://A.example.com/en/x", None), (2, "http://www.example.com/en/", None), (3, "http://example.com/de/", None), (4, "http://x.org/a", canonical("http://y.net/fr/b")), (5, "http://y.net/fr/b#top", None),
        (6, "no url", None), (7, None, None), (8, "http://q.org/1?utm_source=z", None), (9, "http://x.org/a/", "<meta http-equiv=refresh content='0; url=/c'>"), (10, "http://x.org/c", None), (11, "http://notexample.com", None),
        (12, "http://both.org/", canonical("http://y.net/es/1")), (13, "http://both.org", canonical("http://w.com/1")), (None, "http://y.net/es/1", None),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"host": F.lit(1), "node": F.lit(2)})
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.propagated) for r in url_filter.filter_urls(pages).collect()}
    assert got[1] == ("a.example.com", "/en/x", "example.com/en/", "block", False) and got[2][2:4] == ("www.example.com/en/", "allow") and got[3][2:4] == ("com/", "allow")
    assert got[4][2:] == (None, "block", True) and got[5][2:4] == ("net/fr/", "block")
    assert got[6] == got[7] == ("", "", None, "allow", False) and got[8][3:] == ("allow", False)
    assert got[9][3] == got[10][3] == "block" and got[10][4]
    assert got[11] == ("notexample.com", "", None, "allow", False)
    assert got[12][2:] == (None, "allow", True) and got[None][3] == "block"
    more = spark.createDataFrame([("http://q.org/1", "http://z.net/es/1")], "src string, dst string")
    assert {r.page_id: r.verdict for r in url_filter.filter_urls(pages, redirects=more).collect()}[8] == "block"
    assert url_filter.filter_urls(pages.limit(0)).count() == 0 and url_filter.drop_blocked(pages).columns == pages.columns


def test_propagation_is_a_union_find(spark):
    """A long chain, a large star and random links, with allow and block far apart, against a plain union-find."""
    rng = random.Random(4)
    chain = [f"http://chain{i}.org/a" for i in range(200)]
    star = [f"http://leaf{i}.org/" for i in range(400)]
    loose = [f"http://{rng.choice(['x', 'y', 'z'])}{i % 60}.org/p{i}" for i in range(300)]
    links = list(zip(chain, chain[1:])) + [(u, "http://hub.org/") for u in star] + [(rng.choice(loose), rng.choice(loose)) for _ in range(160)]
    links += [(chain[-1], "http://far.net/es/1"), (star[7], "http://s.net/fr/2"), (star[300], "http://s.com/"), ("http://hub.org/", None), (None, chain[0]), (chain[3], chain[3])]
    links += [(rng.choice(loose), f"http://n{i}.net/fr/{i}") for i in range(12)] + [(rng.choice(loose), f"http://c{i}.com/{i}") for i in range(6)]
    rng.shuffle(links)
    urls = chain + star + loose + [u for pair in links for u in pair] + ["http://alone.org/"]
    parent: dict = {}

    def root(u):
        while parent.setdefault(u, u) != u:
            u = parent[u]
        return u

    bare = lambda u: u.split("://")[1].rstrip("/")
    for a, b in links:
        if a and b:
            parent[root(bare(a))] = root(bare(b))
    own = lambda u: "block" if re.search(r"\.net/(es|fr)/", u) else "allow" if ".com/" in u else None
    said: dict = {}
    for u in filter(None, urls):
        if own(u):
            said.setdefault(root(bare(u)), set()).add(own(u))
    want = {}
    for i, u in enumerate(urls):
        known = said.get(root(bare(u)), set()) if u else set()
        want[i] = ((own(u) if u else None) or ("block" if known == {"block"} else "allow"), bool(u and known and not own(u)))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    redirects = spark.createDataFrame(links, "src string, dst string")
    got = {r.page_id: (r.verdict, r.propagated) for r in url_filter.filter_urls(pages, redirects=redirects, html_col=None).collect()}
    assert got == want
    assert got[0] == ("block", True) and got[len(chain)] == ("allow", True) and got[len(urls) - 1] == ("allow", False)


# Top-k


def test_topk_is_brute_force(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(300, 8)).round(2)
    v[50:200] = v[50]  # half of all rows are one vector
    rows = [(int(i), [float(x) for x in v[i]]) for i in range(300)] + [(1000, None), (1100, [1.0, None] + [0.0] * 6), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8), (1400, [1.0, 2.0]), (None, [0.5] * 8)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("far", F.lit(1))
    got = {}
    for r in topk.search(table, F.col("id") % 25 == 0, query_block=5, candidate_block=40).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    q = {i: np.floor(1024 * np.array(x, dtype=np.float32).astype(float)).astype(int) for i, x in rows if i is not None and i < 300} | {1 << 62: np.floor(1024 * np.full(8, 0.5)).astype(int)}
    for i in range(0, 300, 25):
        best = sorted(((-int(q[i] @ x), j) for j, x in q.items() if j != i))[:10]
        assert sorted(got[i]) == [(k + 1, None if j == 1 << 62 else j, -s) for k, (s, j) in enumerate(best)]
    assert set(got) == set(range(0, 300, 25))
    assert topk.search(table.limit(0), F.col("id") % 25 == 0).count() == 0


def test_rows_that_share_an_id(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.9, 0.0]), (1, [0.5, 0.0]), (0, [1.0, 0.0])], "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(table, F.col("id") == 0, k=2).collect())
    assert got == sorted([(0, 1, 0, 1024 * 1024), (0, 2, 0, 921 * 1024)] * 2 + [(0, 1, 0, 1024 * 921), (0, 2, 0, 1024 * 921)])


def test_large_components(spark):
    rows = [(1, [70000.0, 1.0]), (2, [1.0, 2.0]), (3, [-70000.0, 3.0]), (4, [1e8, 1.0]), (5, [0.5, 0.5])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.search(table, F.col("id") > 0).collect()}
    v = {i: [int(np.floor(1024 * c)) for c in x] for i, x in rows}
    for q in v:
        best = sorted((-sum(a * b for a, b in zip(v[q], v[x], strict=True)), x) for x in v if x != q)
        assert [got[q, r + 1] for r in range(4)] == [(x, -s) for s, x in best]
    for bad in ([1e30, 0.0], [4e9, 0.0]):
        with pytest.raises(Exception, match="64-bit|large to convert"):
            topk.search(spark.createDataFrame([*rows, (6, bad)], table.schema), F.col("id") > 0).collect()


def test_share_of_scored_pairs(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(12, 8))[rng.integers(0, 12, 900)] + rng.normal(size=(900, 8)) * 0.01
    table = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    said = topk.scored_share(table, F.col("id") % 50 == 0).first()
    assert said.pairs == 18 * 900 and 18 * 10 <= said.scored < 0.6 * said.pairs


def test_bounds_eliminate():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 1000
    x = (centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)) * 10).astype(np.int64)
    pivots = topk.choose_pivots(x[:500].astype(float), 32)
    far = np.stack([np.linalg.norm(x - p, axis=1) for p in pivots], axis=1)
    ids = np.arange(4000)
    *_, scored = topk.search_block((ids[:10], ids[:10], x[:10], far[:10]), (ids, ids, x, far), 10)
    assert scored < 0.5 * 10 * 4000


# Mixing


def test_targets_and_takes(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), None, s) for i, s in enumerate(rng.choices(["a", "b", "c", "d", None], [6, 1, 1, 1, 1], k=3000))] + [(5000, None, None, "e"), (None, "x y z", None, "a")]
    df = docs_of(spark, rows).withColumn("size", F.lit(1))
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full: set = set()
    while True:
        rate = (1.5 * sum(size.values()) - sum(2 * size[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        new = {s for s in size if s not in full and rate * weight[s] > 2 * size[s]}
        if not new:
            break
        full |= new
    target = {s: 2 * size[s] if s in full else rate * weight[s] for s in size}
    taken: dict = {}
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source]) and r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 40 for s in size)
    copies = mixing.take_mix(df).groupBy("doc_id").count().collect()
    assert {str(r.doc_id): r["count"] for r in copies} == {str(r.doc_id): r.copies for r in got if r.copies}
    assert mixing.mix(df.limit(0)).count() == 0


def brute_mix(rows, weights=(5, 2, 1), share=1.5, most=2.0):
    """taken of each row (id, text, source), by a plain sort of each source."""
    from collections import Counter

    import regex
    import xxhash

    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    odds = [max(round(len(regex.findall(r"\p{L}", t)) / len(t) + 1e-12, 2), 0.05) if t else 0.0 if t is None else 0.05 for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, size, strict=True):
        total[s] += n
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(total, key=lambda s: (s is None, s)))}
    full: set = set()
    while True:
        rate = (share * sum(total.values()) - sum(most * total[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in total if rate * weight[s] > most * total[s]}
        if more == full:
            break
        full = more
    nth, seen = [], Counter()
    for i, t, _ in rows:
        nth.append(seen[i, t])
        seen[i, t] += 1
    taken = [0] * len(rows)
    for s in total:
        target, own = min(most * total[s], rate * weight[s]), [i for i, r in enumerate(rows) if r[2] == s]
        # Expected times: the rate at which the capped ones add up to the target, by bisection.
        low, high = 0.0, 1e9
        for _ in range(200):
            middle = (low + high) / 2
            if sum(size[i] * min(most, middle * odds[i]) for i in own) < target:
                low = middle
            else:
                high = middle
        times = {i: most if target >= most * total[s] else min(most, high * odds[i]) for i in own}
        order, rest = [], target
        for i in own:
            sure = int(times[i])
            taken[i] = sure * size[i]
            rest -= taken[i]
            if (p := times[i] - sure) > 1e-12 and size[i]:
                key = 0 if rows[i][1] is None else xxhash.xxh64_intdigest(rows[i][1].encode(), seed=42)
                key = 42 if rows[i][1] is None else key - (1 << 64) * (key >> 63)
                u = (int(hashlib.md5(f"{'' if rows[i][0] is None else rows[i][0]}:{key}:{nth[i]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                order.append((u / (1 - u) / (p / (1 - p)), i))
        at = 0
        for _, i in sorted(order):
            if at + size[i] / 2 > rest:
                break
            taken[i] += size[i]
            at += size[i]
    return taken


def test_mix_is_a_plain_sort(spark):
    rng = random.Random(12)
    made = lambda: " ".join(rng.choice(["word", "12", "--", "é", "x9"]) for _ in range(rng.randint(0, 30)))
    rows = [(i, made(), rng.choice("aaaaabbcde")) for i in range(700)] + [(None, made(), "a") for _ in range(40)] + [(7, made(), None) for _ in range(40)] + [(9, None, "f"), (None, None, None)]
    want = brute_mix(rows)
    df = docs_of(spark, [(i, t, None, s) for i, t, s in rows]).withColumn("seq", F.lit(1))
    got = mixing.mix(df).collect()
    key = lambda i, s, n: (str(i), str(s), n)
    assert sorted(key(r.doc_id, r.source, r.taken) for r in got) == sorted(key(i, s, n) for (i, _, s), n in zip(rows, want, strict=True))
    assert len({r.copies for r in got if r.source == "a" and r.size}) > 1


@pytest.mark.parametrize("i", [None])
def test_mix_of_repeated_ids(spark, i):
    """All rows share an id, or have none, and most a text too: the target is met all the same, by documents as well."""
    rows = [(i, "w w w w w", None, "a")] * 700 + [(i, f"w w w w {k}", None, "a") for k in range(300)] + [(5, "other " * 100, None, "b")] * 3
    df = docs_of(spark, rows).repartition(6).withColumn("row", F.monotonically_increasing_id())
    got = mixing.mix(df).where("source = 'a'").agg(F.sum("taken"), F.first("target"), F.count("*")).first()
    assert got[2] == 1000 and got[0] == pytest.approx(got[1], abs=5)
    taken = mixing.take_mix(df).cache()
    assert taken.columns == df.columns and taken.where("source = 'a'").count() * 5 == got[0]
    assert taken.groupBy("row").count().where("count > 2").isEmpty()


def test_unequal_odds(spark):
    rows = [(i, "w w w w", "7" if i % 2 else "1", "a") for i in range(4000)] + [(9000 + i, "w " * 100, "1", "b") for i in range(300)]
    df = docs_of(spark, rows)
    got = mixing.mix(df, weights=(1, 9), share=0.5, odds=F.col("lang")).where("source = 'a'").groupBy(F.col("doc_id") % 2).agg(F.avg("copies"), F.sum("taken"), F.first("target")).collect()
    share = {r[0]: r[1] for r in got}
    assert sum(r[2] for r in got) == pytest.approx(got[0][3], abs=4)
    assert 4 < share[1] / share[0] < 12


# Token output


def test_frequent_words_are_encoded_once(monkeypatch):
    monkeypatch.setattr(token_output, "CACHE_ENTRIES", 50)
    made = token_output.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    library, asked = made.tokenizer, []

    class Counting:
        def encode(self, words, **options):
            asked.extend(words)
            return library.encode(words, **options)

        def encode_batch_fast(self, words, **options):
            asked.extend(words)
            return library.encode_batch_fast(words, **options)

    made.tokenizer = Counting()
    for k in range(20):
        texts = [f"zanzibar 's quokka{'x' * j} {'y' * (40 + k)} n{k}_{j}  \u65e5\u672c\n" for j in range(10)] + ["", " ", "\n\n "]
        want = [np.array(library.encode(t, add_special_tokens=False).ids, dtype=made.dtype).tobytes() for t in texts]
        assert made.encode(texts) == want
    assert asked.count("zanzibar") == 1 and asked.count(" quokkax") == 1 and len(made.cache) < 200


def test_shards(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello world", "", None, "don't  stop\n\n", "Ünïcode ⅷ 🙂", "<|endoftext|>x", "a" * 5000, "x y"] * 3
    rows = [(7 * i % 31, t, None, None) for i, t in enumerate(texts)] + [(None, "null", None, None), (-5, "minus", None, None)]
    manifest = token_output.write_shards(docs_of(spark, rows).withColumn("path", F.lit(1)), f"file://{tmp_path}/s", path, public_tokenizers.PATTERN)
    tok = Tokenizer.from_file(path)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for i, t, *_ in order:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((str(i), start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    got = token_output.read_digests(manifest, f"file://{tmp_path}/s").collect()
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    asked = spark.createDataFrame([(0,), (7,), (999,), (-5,)], "doc_id bigint")
    found = token_output.lookup(manifest, f"file://{tmp_path}/s", asked).collect()
    assert {r.doc_id for r in found} == {0, 7, -5} and all(r.ids[-1] == 0 for r in found)
    asked = spark.createDataFrame([(i,) for i in {*[r[0] for r in rows], 999, None}], "doc_id bigint").union(spark.createDataFrame([(0,)], "doc_id bigint"))
    every = lambda df: sorted((str(r.doc_id), list(r.ids)) for r in df.collect())
    assert every(token_output.lookup(manifest, f"file://{tmp_path}/s", asked)) == every(token_output.read_ids(manifest, f"file://{tmp_path}/s"))
    # Copies of one id over several shards, and a second write to the same folder.
    same = [(5, f"text {i % 40}", None, None) for i in range(400)] + [(None, f"none {i}", None, None) for i in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_output.write_shards(docs_of(spark, same), f"file://{tmp_path}/s", path, public_tokenizers.PATTERN)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1
    asked = spark.createDataFrame([(5,), (None,), (6,)], "doc_id bigint")
    assert every(token_output.lookup(manifest, f"file://{tmp_path}/s", asked)) == every(token_output.read_ids(manifest, f"file://{tmp_path}/s"))
    hashed = docs_of(spark, same).where("doc_id = 5").select(F.xxhash64("text").alias("h"), "text").collect()
    want = [[*tok.encode(r.text, add_special_tokens=False).ids, 0] for r in sorted(hashed, key=lambda r: (r.h, r.text))]
    assert [list(r.ids) for r in token_output.read_ids(manifest, f"file://{tmp_path}/s").where("doc_id = 5").collect()] == want
    assert token_output.token_digests(docs_of(spark, []), path, public_tokenizers.PATTERN).count() == 0


def test_tables_are_searched(tmp_path):
    rng, entries = random.Random(1), []
    for i in sorted(rng.sample(range(-10_000, 10_000), 3000)):
        entries.append((sstable.key_of(i), rng.randbytes(rng.randint(0, 200))))
    with open(tmp_path / "t", "wb") as f:
        w = sstable.Writer(f, 2)
        for k, v in entries:
            w.add(k, v)
        w.close()
    with open(tmp_path / "t", "rb") as f:
        r = sstable.Reader(f, w.at)
        assert list(r) == entries and len(r.index) > 3
        assert all(r.get(k) == [v] for k, v in entries[::50])
        assert r.get(sstable.key_of(10_001)) == []
    data = bytearray((tmp_path / "t").read_bytes())
    data[40] ^= 1
    (tmp_path / "t").write_bytes(data)
    with open(tmp_path / "t", "rb") as f, pytest.raises(ValueError, match="damaged"):
        list(sstable.Reader(f, w.at))
