"""Conversation repair, tokenizer alignment and the Jaccard join: brute force on small tables, nulls, repeats, hot groups."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tailmap.llm import alignment, conversations, jaccard_join, token_output

TURNS = "conv_id bigint, turn bigint, role string, text string"
DOCS = "doc_id bigint, text string"

# Conversations


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        kind, (role, text) = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20, shown[2:]
        turns = out.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        turns += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])) for c, v in out.items()}


def cheapest(turns):
    """All numbers of a conversation; the repair by Dijkstra over (turns taken, state)."""
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    seen, faults = set(), []
    for _, role, text in turns:
        filled = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not filled else "duplicate" if (role, text) in seen else "truncated" if filled[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    follows, full = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}], {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, at, state, made = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(turns) and state in (0, 3):
            counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
            return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
        for letter, to in follows[state].items():
            if letter in full:
                heapq.heappush(heap, (cost + 5, audit + "I", at, to, (*made, full[letter] + ":")))
        if at < len(turns):
            _, role, text = turns[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, made))
            if faults[at] in ("", "truncated"):
                more = 5 if faults[at] else 0
                for letter, to in follows[state].items():
                    if role[:1] == letter:
                        heapq.heappush(heap, (cost + more, audit + "K", at + 1, to, (*made, f"{role}:{text}")))
                    if letter in full:
                        heapq.heappush(heap, (cost + more + 1, audit + "R", at + 1, to, (*made, f"{full[letter]}:{text}")))


def digests(spark, rows):
    got = conversations.repair_digests(spark.createDataFrame(rows, TURNS).withColumns({"at": F.lit(1), "audit": F.lit("x")})).collect()
    return {r.conv_id: tuple(r)[1:] for r in got}


def made_up(rng, conv, n):
    texts = ["Yes.", "No", "", "  \t", "Why?", "a.b", "So!", "No.", None, "Ünd. "]
    turn = lambda i: rng.choice([i, i, i, i, i + 1, None])
    return [(conv, turn(i), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), rng.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("bits", [10, 1])
def test_repairs_are_the_cheapest(spark, monkeypatch, bits):
    # Blocks of two rows: most conversations are composed, over several levels.
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    rows = [r for c in range(120) for r in made_up(rng, c, rng.randint(1, 12))] + made_up(rng, None, 20) + made_up(rng, 500, 150)
    rows += [(600, 1, "user", "Same.")] * 40 + [(601, i, "user", "Same.") for i in range(60)]
    want = {c: cheapest(v) for c, v in plain_damage(rows).items()}
    assert digests(spark, rows) == want
    # With these costs a deletion is always cheaper than an insertion.
    assert set("".join(v[6] for v in want.values())) == set("KRD")


def test_conversations_without_rows(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert digests(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert digests(spark, []) == {}


def test_repaired_turns(spark):
    turns = spark.createDataFrame([(1, 0, "system", "Be.", 1), (1, 1, "assistant", "Hello.", 1), (1, 2, "user", "Bye.", 1), (1, 3, "assistant", "Bye.", 2), (2, 0, "assistant", "x" * 100_000 + ".", 1), (2, 1, "assistant", "B.", 1)], TURNS + ", copies bigint")
    ordered, _, edits = conversations.repair(turns)
    got = sorted((r.conv_id, r.place, r.turn, r.role, r.text[:6], r.edit) for r in conversations.repaired_turns(ordered, edits).collect())
    assert got == [(1, 1, 0, "user", "Be.", "R"), (1, 2, 1, "assistant", "Hello.", "K"), (1, 3, 2, "user", "Bye.", "K"), (1, 4, 3, "assistant", "Bye.", "K"), (2, 1, 0, "user", "xxxxxx", "R"), (2, 2, 1, "assistant", "B.", "K")]
    assert {r.conv_id: (r.cost, r.audit) for r in edits.collect()} == {1: (3, "RKKKD"), 2: (1, "RK")}


# Alignment


def plain_alignment(texts):
    """For each text what the libraries' tokens give, every pair of tokens compared."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = alignment.byte_alphabet()
    a_raw = lambda i: bytes(alphabet[c] for c in a_tok.id_to_token(i))
    b_raw = lambda i: bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()

    def spans(ids, raw):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(raw(i)), i))
            at = out[-1][1]
        return out

    found, counts = [], Counter()
    for text in texts:
        a, b = (spans(a_tok.encode(" " + text, add_special_tokens=False).ids, a_raw), spans(b_tok.encode(text), b_raw)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_raw(i) for *_, i in a) != raw or b"".join(b_raw(i) for *_, i in b) != raw:
            found.append(None)
            continue
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        inside = lambda side, lo, hi: ",".join(str(i) for s, e, i in side if lo <= s and e <= hi)
        groups = [f"{inside(a, lo, hi)}|{inside(b, lo, hi)}" for lo, hi in zip([0, *cuts], cuts)]
        links = [(i, j) for s, e, i in a for t, f, j in b if s < f and t < e]
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    rows = [(0,) * 6 + ("",) if x is None else (x[0], x[1], len(x[2]), len(x[3]), sum(counts[k] == most[k[1]] for k in x[3]), sum(counts[k] for k in x[3]), hashlib.sha256(";".join(x[2]).encode()).hexdigest()) for x in found]
    return rows, counts, Counter(g for x in found if x for g in x[2])


def aligned(spark, rows, **options):
    docs = spark.createDataFrame(rows, DOCS).withColumns({"slice": F.lit(1), "group": F.lit("g"), "code": F.lit(2)})
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"), **options)


@pytest.mark.parametrize("slice_chars", [8_000_000, 300])
def test_alignment_is_brute_force(spark, slice_chars):
    rng = random.Random(1)
    odd = ["", None, " ", "  a", "a  b\n\n c\n \n", " x▁y", "🙂\x00é 🙂🙂", "<|endoftext|> <s></s><unk>", "ﬁ ⅷ Ａ", "don't we'll 'tis", "x" * 3000, "日本語のテキスト、です。", "\t\t tab", "a,b;c (d). \"e\"", "　wide", "é"]
    words = ["the", "of", "Zeitgeist", "naïve", "l'été", "12345", "...", "--", "\n", "  ", "東京", "можно", "(see", "p. 7)", "don't"]
    texts = odd + [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[20]), (None, None)] + [(900 + i, "the same text") for i in range(30)]
    want, counts, groups = plain_alignment([t for _, t in rows])
    docs, dictionary, pairs = aligned(spark, rows, slice_chars=slice_chars)
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in docs.collect()) == sorted((str(i), *w) for (i, _), w in zip(rows, want, strict=True))
    assert {r.group: r.freq for r in dictionary.collect()} == groups
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == counts
    assert sum(w[6] == "" for w in want) == 4


def test_alignment_of_a_space_alone(spark):
    # the space at the end is a pre-token of its own, and no piece holds it together with what is before it.
    rows = list(enumerate(["ends in a space ", "京 ", "a\n b ", "A ", "the same ", "the same "]))
    want, counts, groups = plain_alignment([t for _, t in rows])
    docs, dictionary, pairs = aligned(spark, rows)
    assert sorted(tuple(r) for r in docs.collect()) == [(i, *w) for (i, _), w in zip(rows, want, strict=True)]
    assert {r.group: r.freq for r in dictionary.collect()} == groups
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == counts


def test_alignment_of_nothing(spark):
    assert aligned(spark, [])[0].count() == 0
    assert [tuple(r) for r in aligned(spark, [(1, None)])[0].collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


# Jaccard join


def plain_components(rows, percent=90, shingle=3):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)} if len(words) >= shingle else {tuple(words)} - {()})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if rows[i][0] is not None and rows[j][0] is not None and (same or (both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both))):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(d), len(sets[i]), str(least[root(i)] if d is not None else None)) for i, (d, _) in enumerate(rows))


def near_copies(rng, n):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 9, 10, 11, 12, 20, 40, 90, 200]))
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((" " * rng.randint(1, 2)).join(w.upper() if rng.random() < 0.1 else w for w in copy))
    return rows


@pytest.mark.parametrize("rounds", [0, 2])
def test_links_are_those_of_all_pairs(spark, rounds):
    # Without rounds every link is found by the trees; small leaves make several levels.
    rng = random.Random(rounds)
    texts = near_copies(rng, 60)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(rng.choices("abcdefgh", k=30)) for _ in range(30)]
    base = [f"v{i}" for i in range(120)]
    texts += [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in range(0, 120, 2)]
    rows = list(enumerate(texts)) + [(None, texts[3]), (None, None), (5000, None), (5001, " \t"), (7, texts[50]), (5002, texts[9]), (5003, "É é"), (5004, "é é")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"node": F.lit(1), "root": F.lit(2), "roots": F.lit(3)})
    got = jaccard_join.joined_groups(docs, star_rounds=rounds, leaf=2).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == plain_components(rows)
    assert jaccard_join.joined_groups(docs.limit(0)).count() == 0


def test_only_sets_of_pairs_are_compared(spark, monkeypatch):
    base = [" ".join(f"w{k}_{i}" for i in range(60)) for k in range(4)]
    # Two of the four have a near copy; the other two share a long passage with one another, which is too little for a link.
    texts = [*base[:2], *[t + " end" for t in base[:2]], base[2], base[2][: len(base[2]) * 2 // 3] + " " + base[3]]
    seen, linked = [], jaccard_join._linked

    def looked(pairs, sets, percent):
        ends = {x for r in pairs.collect() for x in (r.u, r.v)}
        seen.append(({r.node for r in sets.select("node").collect()}, ends))
        return linked(pairs, sets, percent)

    monkeypatch.setattr(jaccard_join, "_linked", looked)
    got = {r.doc_id: r.component_id for r in jaccard_join.joined_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 1, 4: 4, 5: 5}
    assert seen and all(nodes == ends for nodes, ends in seen) and {0, 1, 2, 3} <= set().union(*[e for _, e in seen])


def test_plain_texts_are_split_by_ranges():
    """Python's own engine, with the same pre-tokens as the pattern's classes give; a pattern that it may read otherwise is left to regex."""
    import random
    import re

    import public_tokenizers
    import regex

    plain = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and not regex.match(token_output.PLAIN, chr(c))]
    for name, ranges in token_output.CLASSES.items():
        assert [c for c in plain if regex.match(name, c)] == [c for c in plain if re.match(f"[{ranges}]", c)]
    split, rng = token_output.plain_split(public_tokenizers.PATTERN), random.Random(9)
    assert isinstance(split.__self__, re.Pattern)
    for _ in range(3000):
        text = "".join(rng.choices(plain, k=9)) + "".join(rng.choices("'stremvld \t\n\r09aÉ²½ª×一-_", k=30))
        assert split(text) == regex.findall(public_tokenizers.PATTERN, text)
    for other in (r"\p{Lu}+|[^\p{Lu}]+", r"(?i:'s)|\p{L}+", r"\w+|\W+"):
        assert not isinstance(token_output.plain_split(other).__self__, re.Pattern)


def test_points_travel_small_and_whole(spark):
    import numpy as np

    for top in (0, 1, 15, 16, 255, 256, 65_535):
        counts = np.array([top, 0, 3, 1, 0, top, 2, 7])
        assert jaccard_join.counts_of(jaccard_join.packed_counts(counts)).tolist() == counts.tolist()
    texts = [" ".join(f"w{k}_{i}" for i in range(300)) for k in range(3)]
    sets = jaccard_join.document_sets(spark.createDataFrame(list(enumerate(texts)), "node bigint, text string"), shingle=3)
    for r in jaccard_join.set_points(sets).collect():
        for k, point in enumerate(r.points):
            groups = jaccard_join.FINER * jaccard_join.size_classes(r.n, jaccard_join.PERCENT)[r.own + k][2]
            assert len(point) <= groups // 2 + 1 and jaccard_join.counts_of(point).sum() == r.n


def test_roots_do_not_travel_to_the_sets_that_hold_them(spark, monkeypatch):
    """Only rows that are copies of others are looked up, and their roots are left out."""
    docs = spark.createDataFrame([(k, f"{k % 3} " + " ".join(f"w{k % 3}_{i}" for i in range(60))) for k in (5, 1, 2, 4, 7, 3, 10)] + [(None, "a b c d"), (11, None)], DOCS)
    seen, stored = {}, jaccard_join.stored

    def kept(df, name):
        seen[name] = stored(df, name)
        return seen[name]

    monkeypatch.setattr(jaccard_join, "stored", kept)
    got = {r.doc_id: r.component_id for r in jaccard_join.joined_groups(docs).collect()}
    assert got == {5: 2, 1: 1, 2: 2, 4: 1, 7: 1, 3: 3, 10: 1, 11: 11, None: None}
    assert seen["copies"].columns == ["row"] and seen["copies"].count() == 4 and seen["held-by-several"].count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_root(percent):
    """Every pair of sets that is just similar enough has a root in common, and enough in its points."""
    import numpy as np

    rng = np.random.default_rng(percent)
    for n in [*range(4, 60), 200, 999, 3000]:
        for m in {n, 100 * n // percent}:
            apart = jaccard_join.apart_at_most(n, m, percent)
            shared = (n + m - apart + 1) // 2
            if shared > n or 100 * shared < percent * (n + m - shared):
                continue
            tokens = rng.integers(0, 1 << 64, n + m - shared, dtype=np.uint64)
            a, b = np.sort(tokens[:n]), np.sort(tokens[n - shared : n - shared + m])
            roots, points = [], []
            for s in (a, b):
                classes = jaccard_join.size_classes(len(s), percent)
                inside = jaccard_join.classes_of(len(s), classes, percent)
                roots.append({int(x) for k in inside for x in jaccard_join.roots_of(s, k, *classes[k][2:])})
                points.append({k: np.diff(jaccard_join.group_bounds(s, classes[k][2])) for k in inside})
            if n == m == shared:
                continue
            assert roots[0] & roots[1], (n, m)
            k = min(set(points[0]) & set(points[1]))
            assert jaccard_join.enough(int(np.minimum(points[0][k], points[1][k]).sum()), n, m, percent)
