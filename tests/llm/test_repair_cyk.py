import hashlib
import itertools
import random
import re

from stallwise.llm import repair_cyk as r

ORDER = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, slice string, audit string"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        said = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """Least (cost, audit, roles and texts) over all edits of a short conversation, up to two inserts in a place."""
    found = []
    inserts = [()] + [t for n in (1, 2) for t in itertools.product("ua", repeat=n)]
    faults = faults_of(rows)
    choices = []
    for (role, text), fault in zip(rows, faults):
        more = 3 if fault == "truncated" else 0
        edits = [(4, "D", None)]
        if fault not in ("blank", "duplicate"):
            edits += [(more, "K", (role, text)), (3 + more, "R", ("user", text)), (3 + more, "R", ("assistant", text))]
        choices.append([(3 * len(i) + c, "I" * len(i) + e, [(dict(u="user", a="assistant")[x], "") for x in i] + ([row] if row else [])) for i in inserts for c, e, row in edits])
    choices.append([(3 * len(i), "I" * len(i), [(dict(u="user", a="assistant")[x], "") for x in i]) for i in inserts])
    for chosen in itertools.product(*choices):
        out = [row for c in chosen for row in c[2]]
        if ORDER.match("".join(role[:1] or "-" for role, _ in out)):
            found.append((sum(c[0] for c in chosen), "".join(c[1] for c in chosen), out))
    return min(found, key=lambda f: f[:2])


def plain_verdict(rows):
    """The same with the standard table: every span, every split."""
    n = len(rows)
    if not n:
        return 0, ""
    kinds = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    leaves = [r.LEAVES[role[:1] if role[:1] in ("s", "u", "a") else "", kinds[f]] for (role, _), f in zip(rows, faults_of(rows))]
    table = {(i, i + 1): leaf for i, leaf in enumerate(leaves)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cells = {}
            for split in range(i + 1, i + length):
                for symbol, cell in r.joined(table[i, split], table[split, i + length]).items():
                    r.least(cells, symbol, cell)
            table[i, i + length] = cells
    ended = r.joined(table[0, n], r.CLOSURE)
    return min(ended[0, q] for q in r.ENDS if (0, q) in ended)


def random_rows(rng, n):
    texts = ["Well.", "So!", "no end", "", " \t", "Why?"]
    return [(rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), rng.choice(texts)) for _ in range(n)]


def test_all_splits_agree_with_neighbour_spans():
    rng = random.Random(2)
    for _ in range(300):
        rows = random_rows(rng, rng.randint(0, 12))
        parse = r.Parse()
        for (role, _), fault in zip(rows, faults_of(rows)):
            parse.row(role[:1], ["", "blank", "duplicate", "truncated"].index(fault), None)
        assert parse.verdict() == plain_verdict(rows)


def test_least_of_all_edits():
    rng = random.Random(3)
    for _ in range(25):
        rows = random_rows(rng, rng.randint(0, 3))
        assert plain_verdict(rows) == brute(rows)[:2]


def expected(rows):
    """Plain result for one conversation of (turn, role, text), already in order."""
    said = [(role, text) for _, role, text in rows]
    faults = faults_of(said)
    cost, audit = plain_verdict(said)
    out, state, i = [], 0, 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else said[i]
        i += edit != "I"
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else r.WANTED[state]
        out.append(f"{role if edit == 'K' else r.ROLE[initial]}:{text}")
        state = r.STEP[state, initial]
    assert ORDER.match("".join(o[0] for o in out))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:]))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def in_order(rows):
    def key(row):
        turn, role, text = row
        return turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()

    return sorted([(t, " " if role is None else role, " " if text is None else text) for t, role, text in rows], key=key)


def test_equals_plain_version_over_slices(spark):
    """One conversation has most rows and lies in many slices; nulls, ties, repeated rows, a long text, clashing columns."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    conversations = {c: [(rng.choice([i, i, i, 2 * i]), *row) for i, row in enumerate(random_rows(rng, rng.randint(1, 6)))] for c in range(40)}
    conversations[None] = [(None, None, None), (3, "user", None), (3, None, "x."), (None, "user", "Hi.")]
    conversations[100] = [(i, *row) for i, row in enumerate(random_rows(rng, 110))]
    conversations[101] = [(7, "user", "Same.")] * 60 + [(8, "assistant", "x" * 400_000)]
    conversations[102] = [(-(2**62), "user", "a."), (2**62, "assistant", "b.")]
    flat = [(c, *row, "s", "a") for c, rows in conversations.items() for row in rows] + [(200, 1, "gone", "gone", "s", "a")]
    rng.shuffle(flat)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(flat, SCHEMA).repartition(3)
        ordered = r.prepared(df, F.col("conv_id").eqNullSafe(200))
        assert ordered.where("conv_id = 100 or conv_id = 101").select(r.slice_of()).distinct().count() > 1
        got = {x.conv_id: tuple(x)[1:] for x in r.with_digests(df, F.col("conv_id").eqNullSafe(200)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got.pop(200) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got == {c: expected(in_order(rows)) for c, rows in conversations.items()}


def test_empty_table(spark):
    assert r.with_digests(spark.createDataFrame([], SCHEMA)).collect() == []
