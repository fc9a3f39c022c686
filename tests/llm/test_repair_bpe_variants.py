"""Conversation repair, boundary BPE and spelling variants against plain versions of their contracts."""

from __future__ import annotations

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from lumenloom.llm import boundary_bpe, conversation_repair, spelling_variants
from tests.llm import brute

CONVERSATIONS = "conv_id long, turn long, role string, text string, copies int, low long, audit string, open boolean"
SOLID = re.compile(r"[^\x20\x09-\x0D]")
VALID = re.compile(r"(s?(ua)+)?")


def conversations(spark, rows):
    """Rows with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, 7, 7, "x", True) for r in rows], CONVERSATIONS)


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        rule = zlib.crc32(key.encode()) % 20
        if rule == 0:
            continue
        text = "" if rule == 1 else re.sub(r"[.!?]", "", text) if rule == 2 else text
        out += [(conv, turn, "user" if rule == 4 else role, text)] * (2 if rule == 3 else 1)
    return out


def fault_of(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_repair(rows, faults):
    """Least (cost, letters) by trying all edits, up to two inserts in every gap."""
    edits = []
    for (role, _), fault in zip(rows, faults):
        stay = 3 if fault == "truncated" else 0
        edits.append([("D", 4, "")] + ([] if fault in ("blank", "duplicate") else [("K", stay, role[:1]), ("R", 3 + stay, "u"), ("R", 3 + stay, "a")]))
    gap = [("", 0, "")] + [("I" * n, 3 * n, "".join(p)) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    steps = [gap]
    for e in edits:
        steps += [e, gap]
    best = min((sum(c for _, c, _ in path), "".join(a for a, _, _ in path)) for path in itertools.product(*steps) if VALID.fullmatch("".join(i for _, _, i in path)))
    return best


def cheapest_repair(rows, faults):
    """Least (cost, letters) from every row on, as pairs rather than integers."""
    leads = {"": "u", "s": "u", "u": "a", "a": "u"}
    onward = {last: (0, "") if last in ("", "a") else (10**9, "") for last in leads}
    for i in range(len(rows), -1, -1):
        here = onward
        if i < len(rows):
            here, stay = {}, 3 if faults[i] == "truncated" else 0
            for last in leads:
                options = [(onward[last][0] + 4, "D" + onward[last][1])]
                if faults[i] not in ("blank", "duplicate"):
                    c, a = onward[leads[last]]
                    options.append((c + 3 + stay, "R" + a))
                    initial = rows[i][0][:1]
                    if initial == leads[last] or (initial, last) == ("s", ""):
                        c, a = onward[initial]
                        options.append((c + stay, "K" + a))
                here[last] = min(options)
        onward = here
        for _ in range(2):  # inserts before the row
            onward = {last: min(here[last], (onward[to][0] + 3, "I" + onward[to][1])) for last, to in leads.items()}
    return onward[""]


def repaired_hash(rows, audit):
    out, last, i = [], "", 0
    leads = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[i]
        i += letter != "I"
        if letter == "D":
            continue
        role = role if letter == "K" else leads[last]
        out.append(f"{role}:{text}")
        last = role[:1]
    assert i == len(rows)
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(rows, cheapest):
    want, kept = {}, collections.defaultdict(list)
    for conv, turn, role, text in after_damage(rows):
        kept[conv].append((turn, role, text))
    for conv in {r[0] for r in rows}:
        mine = sorted(kept[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        pairs = [r[1:] for r in mine]
        found, turns = fault_of(pairs), {r[0] for r in mine} - {None}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit = cheapest(pairs, found)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        want[conv] = (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, repaired_hash(pairs, audit))
    return want


def reported(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", None, "admin"]


def some_rows(r, conv, n):
    texts = ["Yes.", "yes", "Why? ", "", " \t", None, "no end", "Ends!\n", "A. b"]
    return [(conv, r.choice([None, r.randrange(12)]) if r.random() < 0.1 else t, r.choice(ROLES), f"{r.choice(texts) or ''}{r.randrange(3)}." if r.random() < 0.5 else r.choice(texts)) for t in range(n)]


def test_repairs_of_short_conversations_against_all_edits(spark):
    r = random.Random(3)
    rows = [row for conv in range(60) for row in some_rows(r, conv if conv else None, r.randrange(1, 4))]
    assert reported(conversation_repair.report(conversations(spark, rows))) == expected(rows, every_repair)


def test_repairs_in_pieces_over_many_tasks(spark):
    """Conversations of up to 400 rows in pieces of three rows; one has half of all rows."""
    r = random.Random(5)
    rows = [row for conv in range(40) for row in some_rows(r, conv, r.choice([1, 2, 7, 20]))] + some_rows(r, 99, 400)
    rows += [(99, 500, "user", "again and again.")] * 50  # copies of one row
    many = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    for k, v in many.items():
        spark.conf.set(k, v)
    try:
        got = reported(conversation_repair.report(conversations(spark, rows), piece=3))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == expected(rows, cheapest_repair)


def test_the_matrix_of_pieces_is_the_path_of_the_whole():
    r = random.Random(8)
    for _ in range(200):
        codes = tuple((r.choice("suat"), r.randrange(3)) for _ in range(r.randrange(1, 12)))
        cuts = sorted(r.choices(range(1, len(codes) + 1), k=2))
        pieces = [p for p in (codes[: cuts[0]], codes[cuts[0] : cuts[1]], codes[cuts[1] :]) if p]
        matrices = [conversation_repair.matrix(p) for p in pieces]
        assert conversation_repair.finished(functools.reduce(conversation_repair.multiplied, matrices)) == conversation_repair.cheapest(codes)


def test_repaired_rows(spark):
    rows = conversations(spark, [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hm"), (2, 0, "user", " ")]).drop("copies").selectExpr("conv_id", "turn", "role", "text", "1 AS copies")
    plan = conversation_repair.plans(rows)
    got = sorted((r.conv_id, r.position, r.role, r.text, r.edit) for r in conversation_repair.repaired(rows, plan).collect())
    assert got == [(1, 0, "user", "", "I"), (1, 1, "assistant", "Hello.", "K")]
    assert {r.conv_id: (r.cost, r.audit) for r in plan.collect()} == {1: (7, "IKD"), 2: (4, "D")}
    assert conversation_repair.report(conversations(spark, [])).count() == 0


@pytest.fixture(scope="module")
def public():
    return pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks(public):
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return boundary_bpe.Ranks(file.read(), public.PATTERN)


@pytest.fixture(scope="module")
def reference(public, ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})


ALPHABETS = ["ab", "aAbB", "abcdefgh", "é ü", "aaaaab", "0123456789", "=-_*# ", "的是不我一", "\r\n\t  x", "'s've I'll", "😀👍🏽a", "̀e‍"]


def test_joined_halves_are_the_encoding(ranks, reference):
    r = random.Random(1)
    for _ in range(1500):
        text = "".join(r.choices(r.choice(ALPHABETS), k=r.randint(0, 150)))
        assert ranks.encode(text).tolist() == reference.encode_ordinary(text)
        data, at = text.encode(), r.randint(0, 150)
        assert ranks.joined(ranks.merged(data[:at]), ranks.merged(data[at:])) == ranks.merged(data)
    for text in ("a" * 20_001, "ab" * 9_999, "=" * 5_000, " " * 3_000 + "x", "word " * 40_000, "xyz" * 70_000 + " end " * 9):
        assert ranks.encode(text).tolist() == reference.encode_ordinary(text)
        assert ranks.decode(ranks.encode(text)) == text.encode()


def test_every_character_is_matched_alike(ranks, reference):
    for low in range(0, 0x30000, 512):
        text = "".join(f"a{c}b{c}1{c} {c}\n{c}!" for c in map(chr, range(low, low + 512)) if not 0xD800 <= ord(c) < 0xE000)
        assert ranks.encode(text).tolist() == reference.encode_ordinary(text)


def test_ranks_that_no_merge_reaches_are_refused():
    with pytest.raises(ValueError, match="not reached"):
        boundary_bpe.Ranks(b"YQ== 0\nYg== 1\nYWJh 2", r"\S+")  # a, b and aba without ab or ba


def test_bpe_digests(spark, public, reference):
    r = random.Random(2)
    texts = [None, "", " ", "plain words, twice: plain words.", "x" * 5_000, "word " * 30_000]
    texts += ["".join(r.choices("".join(ALPHABETS), k=r.randint(1, 400))) for _ in range(60)]
    rows = [(i if i != 3 else None, t, b"clash", [1]) for i, t in enumerate(texts + texts[:4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, data binary, ids array<int>")
    path = public.path("byte_bpe_50k.tiktoken")
    got = boundary_bpe.digests(docs, path, public.PATTERN).collect()
    want = []
    for i, t, _, _ in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert boundary_bpe.digests(docs.limit(0), path, public.PATTERN).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(boundary_bpe.decode(nothing, path, public.PATTERN).first().data) == b""


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(rows):
    counts = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(brute.LOW)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, some in close.items():
        top = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top and n[top] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n}


def test_spelling_variants(spark):
    r = random.Random(6)
    words = ["".join(r.choices("abcdeé", k=r.randint(6, 9))) for _ in range(30)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "x×y÷zß", "cathedral"]

    def edited(w):
        i, kind = r.randrange(len(w)), r.randrange(3)
        return w[:i] + ["", r.choice("abcdeé"), w[i] + r.choice("abcdeé")][kind] + w[i + 1 :]

    weights = {w: 5 * 6 ** r.randrange(4) for w in words}
    for w in words:
        for _ in range(4):
            weights.setdefault(edited(w), 5 * 5 ** r.randrange(3))
            weights.setdefault(edited(edited(w)), 5 + r.randrange(3))
    runs = [w.capitalize() if r.random() < 0.2 else w for w, k in weights.items() for _ in range(k)]
    r.shuffle(runs)
    rows = [(i if i % 11 else None, " ".join(runs[50 * i : 50 * i + 50]) + r.choice(["", ".", "\n", "1"])) for i in range(len(runs) // 50 + 1)]
    rows += [(5, None), (6, ""), (7, rows[3][1]), (7, rows[3][1])]
    docs = spark.createDataFrame([(*x, "k", 1) for x in rows], "doc_id long, text string, word string, n int")
    want = expected_variants(rows)
    assert sum(f is not None for f, *_ in want.values()) > 20 and any(f and f != t for f, t, *_ in want.values())
    assert {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling_variants.variants(docs).collect()} == want
    assert spelling_variants.variants(docs.limit(0)).count() == 0


def test_near_pairs_come_once(spark):
    r = random.Random(7)
    words = sorted({"".join(r.choices("abc", k=r.randint(6, 8))) for _ in range(300)})
    got = [tuple(sorted(x)) for x in spelling_variants.near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    assert sorted(got) == sorted((a, b) for a, b in itertools.combinations(words, 2) if near(a, b))
