"""Chat windows, periodic runs and spelling variants against brute force on small inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import chat, periodic_runs, queries, spelling, token_counts

SF = "/root/testdata/sf0.001"
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]

# 11 --------------------------------------------------------------------------------------------------------------

CHATS = "conv_id long, turn long, role string, text string, piece string, segment string, n_tokens long"


def chats():
    rng = random.Random(4)
    rows = []
    for c in list(range(40)) + [None]:
        n = rng.choice([0, 1, 2, 3, 7, 30, 90])
        turns = list(range(n))
        if rng.random() < 0.4 and n:
            rows.append((c, -1, "system", "be " * rng.randint(0, 30)))
        for t in turns:
            words = [rng.choice(["w", "ég", "\n", "\\", *CONTROLS, "<\\s>", "[\\\\INST]"]) for _ in range(rng.randint(0, 25))]
            role = rng.choice(["user", "assistant", "assistant", "tool", "[ROLE]x", "system", None])
            rows.append((c, None if rng.random() < 0.05 else t, role, None if rng.random() < 0.1 else " ".join(words)))
    rows += [(50, 0, "assistant", "x" * 5000), (51, 3, "user", "a"), (51, 3, "user", "a"), (52, 0, "assistant", "")]
    rng.shuffle(rows)
    return rows


def by_turn(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}


def chat_frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "s", 1) for r in rows], CHATS)


@pytest.mark.parametrize("segment", [1, 64])
def test_windows_give_every_turn_back_once(spark, segment):
    rows = chats()
    budget, history = 120, 40
    got = chat.format_chats(chat_frame(spark, rows), budget, history, segment=segment).collect()
    want = by_turn(rows)
    turns, targets = {}, {}
    for w in sorted(got, key=lambda w: (w.conv_id is None, w.conv_id or 0, w.segment, w.window)):
        parsed = chat.parse(w.text)
        repeated = w.system_turns + w.history_turns
        assert len(parsed) == repeated + w.new_turns and w.new_turns > 0
        seen = turns.setdefault(w.conv_id, [])
        if w.history_turns:  # the turns just before, as many as fit
            assert parsed[w.system_turns:repeated] == seen[-w.history_turns:]
        if w.system_turns:
            assert seen and parsed[0] == want[w.conv_id][0]
        new = parsed[repeated:]
        cost = [-(-len(x.encode()) // 4) + 2 for _, x in parsed]
        assert sum(cost) == w.n_tokens and (w.n_tokens <= budget or repeated - w.system_turns == 0 and w.new_turns == 1)
        assert sum(cost[w.system_turns:repeated]) <= history
        seen.extend(new)
        masked = [chat.unescape(w.text[p.start:p.end]) for p in w.loss]
        assert masked == [x for r, x in new if r == "assistant"]
        targets.setdefault(w.conv_id, []).extend(masked)
        assert not any(t in chat.UNESCAPE.sub("", w.text[p.start:p.end]) for t in CONTROLS for p in w.loss)
    assert turns == want
    assert targets == {c: [x for r, x in v if r == "assistant"] for c, v in want.items()}
    report = chat.chat_report(chat_frame(spark, rows), budget, history, segment=segment).collect()
    assert len(report) == len(want)
    for r in report:
        said = "".join(f"{a}\n{b}\n" for a, b in want[r.conv_id])
        loss = "".join(b for a, b in want[r.conv_id] if a == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(want[r.conv_id]), len(loss))
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(w.text) for w in got if w.conv_id == r.conv_id)


def test_segments_cut_long_conversations(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], "word " * 20) for t in range(400)]
    df = chat_frame(spark, rows)
    cut = chat.format_chats(df, 200, 60, segment=4)
    assert cut.select("segment").distinct().count() > 8
    later = cut.filter("window = 0 and segment > 0").collect()
    assert all(w.history_turns == 2 for w in later)  # history reaches over a segment's edge


def test_spans_follow_the_greedy_rule():
    rng = random.Random(2)
    for _ in range(300):
        tokens = [rng.randint(1, 40) for _ in range(rng.randint(1, 30))]
        led = rng.random() < 0.5
        budget, history = rng.randint(5, 90), 0
        history = rng.randint(0, budget - 1)
        ends = [0]
        for t in tokens:
            ends.append(ends[-1] + t)
        got = chat.spans(ends, tokens[0] if led else 0, led, 0, budget, history)
        s = 0
        for h, a, e in got:
            assert a == s
            front = tokens[0] if led and s else 0
            fits = [k for k in range(1 if led and s else 0, s)
                    if sum(tokens[k:s]) <= history and front + sum(tokens[k:s + 1]) <= budget]
            assert h == min(fits, default=s)
            ends_here = [k for k in range(s + 1, len(tokens) + 1) if front + sum(tokens[h:k]) <= budget]
            assert e == max(ends_here, default=s + 1)
            s = e
        assert s == len(tokens)


def test_chat_edges(spark):
    assert chat.format_chats(chat_frame(spark, [])).count() == 0
    assert chat.chat_report(chat_frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        chat.format_chats(chat_frame(spark, []), budget=10, history=10)
    for text in [*CONTROLS, "<\\s>", "[\\\\/INST]", "<<s>", "<<</SYS>>>", "\\", "a<b[c"]:
        df = spark.createDataFrame([(text,)], "t string").select(chat.escaped(F.col("t")).alias("e"))
        e = df.first().e
        assert chat.unescape(e) == text and not any(c in e for c in CONTROLS)


def test_windows_by_a_tokenizers_counts(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], "some words to count %d" % t) for t in range(6)]
    df = chat_frame(spark, rows).withColumn("key", F.col("turn"))
    counts = token_counts.token_counts(df, id_col="key").select("key", F.col("n_tokens").alias("tokens"))
    got = chat.format_chats(df.join(counts, "key"), 40, 0, tokens_col="tokens").collect()
    n = {r.key: r.tokens + 2 for r in counts.collect()}
    assert sum(w.n_tokens for w in got) == sum(n.values()) and all(w.n_tokens <= 40 for w in got)


# 12 --------------------------------------------------------------------------------------------------------------

def brute_runs(w, least):
    out, seen, n = [], set(), len(w)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p) and (i, j + p) not in seen:
                seen.add((i, j + p))
                out.append((i, j + p - i, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def run_texts():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(150):
        n, letters = int(rng.integers(0, 200)), int(rng.integers(1, 6))
        w = ["é%d" % x for x in rng.integers(0, letters, n)]
        if rng.random() < 0.5 and n > 4:
            p, s = int(rng.integers(1, n // 2 + 1)), int(rng.integers(0, n - 1))
            w[s:] = [w[s + k % p] if s + k % p < n else w[s] for k in range(n - s)]
        rows.append((i, "  ".join(w) + "\n"))
    long = ["w%d" % x for x in rng.integers(0, 900, 3000)]
    return rows + [(200, None), (201, ""), (202, " \t "), (203, "a " * 11), (204, "a\x0b" * 12), (None, "b a " * 20),
                   (205, " ".join(long + long)), (206, "a b c d e f a b c d e f"), (206, "a b c d e f a b c d e f"),
                   (207, " ".join("a" * 3000))]


def run_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r", "c") for i, t in rows],
                                 "doc_id long, text string, n_words long, runs string, collapsed string")


@pytest.mark.parametrize("least", [2, 12])
def test_periodic_runs(spark, least):
    rows = run_texts()
    got = periodic_runs.periodic_runs(run_frame(spark, rows), min_length=least).collect()
    want = []
    for i, t in rows:
        w = (t or "").split()
        runs = brute_runs(w, least)
        want.append((i, len(w), tuple(runs), brute_collapsed(w, runs)))
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == Counter(want)


def test_run_digests_over_planted_documents(spark):
    rows = run_texts()
    df = run_frame(spark, rows)
    planted = df.select("doc_id", periodic_runs.repeated_stretch(F.col("doc_id"), F.col("text")).alias("text"))
    got = {(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in periodic_runs.run_report(planted).collect()}
    want, changed = set(), 0
    for i, t in rows:
        w = (t or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        runs = brute_runs(w, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        lines = "".join("%d,%d,%d\n" % r for r in runs)
        want.add((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                  hashlib.sha256(lines.encode()).hexdigest(),
                  hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()))
    assert changed > 5 and got == want


def test_no_runs_of_an_empty_table(spark):
    assert periodic_runs.run_report(run_frame(spark, [])).count() == 0


def test_common_extensions():
    rng = np.random.default_rng(5)
    seq = np.concatenate([rng.integers(0, 2, 500), np.tile(rng.integers(0, 3, 37), 12), [9]])
    ext = periodic_runs.CommonExtensions(seq)
    i, j = rng.integers(0, len(seq), (2, 3000))
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i, j, ext(i, j)):
        k = 0
        while max(a, b) + k < len(seq) and seq[a + k] == seq[b + k]:
            k += 1
        assert k == got


def test_runs_of_a_very_long_text():
    words = b"x y z " * 150_000 + b"end"
    sizes, runs, *_ = periodic_runs._block([words], 12)
    assert sizes[0] == 450_001 and [tuple(r) for r in runs] == [(1, 450_001, 3)]


# 13 --------------------------------------------------------------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts, ratio=5):
    form, met = {}, {}
    for w, n in counts.items():
        friends = [v for v in counts if near(w, v)]
        best = min(friends, key=lambda v: (-counts[v], v)) if friends else None
        form[w] = best if best and counts[best] >= ratio * n else None
        met[w] = len(friends)
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, met[w], counts[form[w]] if form[w] else None))
    return rows


@pytest.mark.parametrize("block", [1, 7, 16384])
def test_spelling_variants(spark, block):
    rng = random.Random(block)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([5, 6, 25, 26, 130, 700, 3500, 90000])
              for _ in range(300)}
    counts |= {"a" * k: 5 ** (k % 7) for k in range(1, 14)} | {"本語": 9, "本x": 50, "z" * 700: 5, "z" * 701: 60}
    rows = [(w, n, "f", "r", 1) for w, n in counts.items()] + [(None, 3, "f", "r", 1), ("", 3, "f", "r", 1)]
    words = spark.createDataFrame(rows, "word string, n long, form string, root string, rank long")
    got = spelling.spelling_variants(words, block=block)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute_variants(counts)
    assert spelling.spelling_variants(words.limit(0)).count() == 0


def test_trie_nodes_number_prefixes(spark):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 8))) for _ in range(150)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for block in (1, 3, 16, 1000):
        for r in spelling.trie_nodes(df, block).collect():
            assert words[r["rank"]] == r.word
            assert r.nodes == [next(i for i, w in enumerate(words) if w[:d] == r.word[:d]) for d in range(1, len(r.word) + 1)]


def brute_counts(rows, least=6, often=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= often}


def test_word_counts(spark):
    rng = random.Random(3)
    words = ["Ökologie", "ÖKOLOGIE", "straße", "Straßen", "houses", "x" * 90, "abc", "naïveté", "données", "DONNÉES"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "9", "-", "ÿ"]) for _ in range(80))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "houses houses"), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n long, word string")
    got = {r.word: r.n for r in spelling.count_words(df, change=spelling.slipped).collect()}
    assert got == brute_counts(rows)
    assert spelling.count_words(df.limit(0)).count() == 0


def test_registered_spelling_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {tuple(r) for r in queries.op13_trie_pair_variants(spark, SF).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_variants(brute_counts(docs))
