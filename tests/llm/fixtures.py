"""Small tables with everything that may go wrong, and brute-force versions of the operators."""

import random

WORDS = "the of lorem ipsum dolor amet nulla tempor magna aliqua über straße café naïve 東京 data model token merge sort".split()
CLASHING = "n int, run long, size string, print string, node int, digest string, kept string, target int, doc long, bucket int, copies int, score string, start int, offset int, host string, file string, __row int, __text string, __id int, __size int, __copies string, __times int, __lost string, __any string, row string, `key` string, times string, gone string"


def text(rng, n):
    out = []
    for k in range(n):
        out.append(rng.choice(WORDS) + str(rng.randrange(300)))
        out.append(rng.choice([" ", " ", " ", "\n", ". ", "\t"]) if k < n - 1 else "")
    return "".join(out)


def documents(spark, rows=None):
    """(doc_id, text, lang, source, n_chars) with columns whose names clash with those that operators use inside."""
    rows = rows if rows is not None else odd_rows()
    extra = (1, 2, "s", "p", 3, "d", "k", 4, 5, 6, 7, "c", 8, 9, "h", "f", 1, "t", 2, 3, "c", 4, "l", "a", "r", "k", "t", "g")
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


def odd_rows(seed=7):
    rng = random.Random(seed)
    rows = []
    passage = text(rng, 60)
    for k in range(60):
        body = text(rng, rng.choice([1, 2, 4, 30, 120]))
        if k % 9 == 0:
            body += "\n" + passage + "\n" + text(rng, 20)
        rows.append((k * 3 + 5, body, "en", rng.choice(["a", "b", "é", None]), len(body)))
    long_ = text(rng, 30_000)
    rows += [(900, long_, "en", "a", 0), (901, long_.replace(" ", "  "), "en", "b", 0), (902, long_[:-9] + "changed", "en", "b", 0)]
    rows += [(910, None, None, None, None), (911, "", "", "", 0), (912, "  \n\t", "en", "a", 4), (None, "no id here", "en", "a", 1), (None, None, "en", "a", 1)]
    rows += [(920, rows[0][1], "en", "b", 1), (921, rows[0][1] + " tail", "en", "b", 1), (930, "twice", "en", "a", 5), (930, "twice", "en", "a", 5), (931, "other text one", "en", "a", 5), (931, "other text two", "en", "b", 5)]
    rows += [(940, "ab" * 5000, "en", "a", 1), (941, "x" * 1000, "en", "b", 1), (942, "x" * 199, "en", "b", 1), (943, "x" * 200, "en", None, 1), (944, "nospace" * 300, "en", None, 1)]
    rng.shuffle(rows)
    return rows
