from stratakit.llm import canonical as C

REF = [(1, "r", "Target depth reached"), (2, "r", "Cone refusal on gravel"), (3, "r", "Inclination limit exceeded"), (4, "n", "Assumed level"), (5, "n", "Dipper reading"), (6, None, "x"), (7, "r", None)]


def run(spark, values, ref=REF):
    v = spark.createDataFrame([(i, f, s, 1) for i, f, s in values], "value_id long, field string, value string, entry_id int")
    r = spark.createDataFrame(ref, "entry_id int, field string, entry string")
    return {(x["value_id"], x["field"]): x["entry_id"] for x in C.canonical(v, r).collect()}


def test_spellings(spark):
    values = [
        (1, "r", "Target depth reached"), (2, "r", "TARGET-DEPTH-REACHED"), (3, "r", "depth reched Targget"), (4, "r", "Targetdepthreacehd"), (5, "r", "refsual on grvel"),
        (6, "r", "due to Inclin. limit éxceeded (op)"), (7, "r", "photo 84"), (8, "r", ""), (9, "r", "  "), (10, "r", None), (11, "n", "levelAssumed, 161CM bgl"), (12, "n", "50 mm pipe"),
        (13, "n", "Dippr reading in ft."), (14, "n", "Target depth reached"), (15, "other", "Dipper reading"), (16, "n", "reading " * 20_000), (11, "n", "levelAssumed, 161CM bgl"), (None, "n", "asumed level"),
    ]
    got = run(spark, values)
    assert (1, "r") not in got and (10, "r") not in got
    assert got == {
        (2, "r"): 1, (3, "r"): 1, (4, "r"): 1, (5, "r"): 2, (6, "r"): 3, (7, "r"): 0, (8, "r"): 0, (9, "r"): 0, (11, "n"): 4, (12, "n"): 0, (13, "n"): 5,
        (14, "n"): 0, (15, "other"): 0, (16, "n"): got[(16, "n")], (None, "n"): 4,
    }


def test_run_together_words_in_every_order(spark):
    from itertools import permutations

    ref = [(1, "r", "Target depth reached"), (2, "r", "Cone refusal on gravel"), (3, "r", "Obstruction encountered")]
    meant = [(i, "".join(p)) for i, _, entry in ref for p in permutations(entry.split())]
    got = run(spark, [(n, "r", v) for n, (_, v) in enumerate(meant)], ref)
    assert got == {(n, "r"): i for n, (i, _) in enumerate(meant)} and len(got) == 6 + 24 + 2


def test_nothing(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, "r", "Target depth reached")], []) == {(1, "r"): 0}


def test_pigeonhole_finds_everything_within_k(spark):
    """Against every pair: no pair within k edits is missed."""
    import random

    rng = random.Random(4)
    refs = ["".join(rng.choice("abcd") for _ in range(rng.randint(6, 14))) for _ in range(12)]

    def edit(s, n):
        for _ in range(n):
            i = rng.randrange(len(s) + 1)
            s = rng.choice([s[:i] + rng.choice("abcd") + s[i:], s[:i] + s[i + 1 :], s[:i] + rng.choice("abcd") + s[i + 1 :]])
        return s

    values = [edit(r, n) for r in refs for n in range(5) for _ in range(3)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    v = spark.createDataFrame([(s,) for s in set(values) if s], "value string")
    r = spark.createDataFrame([(s, 3) for s in set(refs)], "form string, k int")
    got = {(x["value"], x["form"]): x["edits"] for x in C.pigeonhole(v, "value", r, "form", "k").collect()}
    want = {(a, b): distance(a, b) for a in set(values) if a for b in set(refs) if distance(a, b) <= 3}
    assert got == want and len(want) > 40
