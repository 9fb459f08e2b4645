import random

from pyspark.sql import functions as F

from wareflow.operators.handles import unique_handles, unique_handles_counter


def loop_counter(bases):
    taken, out = set(), []
    for base in bases:
        handle, k = base, 0
        while handle in taken:
            k += 1
            handle = f"{base}-{k}"
        taken.add(handle)
        out.append(handle)
    return out


def loop_codes(rows):
    taken, out = set(), {}
    for no, base, upc in rows:
        names = [base, f"{base}-{upc[-4:]}", f"{base}-{upc}"]
        handle = next((x for x in names if x not in taken), None)
        k = 1
        while handle is None:
            handle = f"{base}-{k}" if f"{base}-{k}" not in taken else None
            k += 1
        taken.add(handle)
        out[no] = handle
    return out


def test_counter_handles_with_clashing_families(spark):
    for seed in range(4):
        rng = random.Random(seed)
        bases = [rng.choice(["x", "x", "x", "x-1", "x-2", "x-1-1", "x-10", "y", "x-1-2"]) for _ in range(60)]
        df = spark.createDataFrame(list(enumerate(bases)), "row_no bigint, base string").repartition(3)
        got = {r.row_no: r.handle for r in unique_handles_counter(df, F.col("base")).collect()}
        assert [got[i] for i in range(len(bases))] == loop_counter(bases), seed


def test_group_handles_with_clashes_across_bases(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(i, rng.choice(["a", "a", "a 1234", "b", "a 1"]), rng.choice(["991234", "1234", "881234", "1", "2"])) for i in range(30)]
        df = spark.createDataFrame(
            [(100 + i, i, "z", base, upc) for i, base, upc in rows],
            "group_no bigint, group_index bigint, brand string, base_name string, upc string",
        )
        got = {r.group_no - 100: r.handle for r in unique_handles(df).collect()}
        want = loop_codes([(i, "z-" + base.replace(" ", "-"), upc) for i, base, upc in rows])
        assert got == want, seed
        assert len(set(got.values())) == len(rows)
