import random
import re

import numpy as np
import pyarrow as pa

from weftline.llm import licenses as lc
from weftline.llm.textcode import column_bytes


def words(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(text):
    """license -> greatest share of a template's shingles in one stretch, where it is 0.8 or more."""
    out = {}
    w = words(text)
    for name, texts in lc.TEMPLATES.items():
        for t in texts:
            v = words(t)
            k = min(5, len(v))
            want = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)}
            got = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            width = int(np.ceil(len(want) * 1.25))
            best = max((len(want.intersection(got[i : i + width])) / len(want) for i in range(len(got))), default=0)
            if best >= lc.CONTAINED:
                out[name] = max(best, out.get(name, 0))
    return out


def cases(n=150):
    rng = random.Random(6)
    vocab = ["lorem", "ipsum", "license", "the", "Été", "software", "work", "4", "0"]
    filler = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    every = [t for ts in lc.TEMPLATES.values() for t in ts]
    out = [None, "", "All rights", "ALL RIGHTS RESERVED", "all, rights: reserved."]
    for _ in range(n):
        t = filler(rng.randint(0, 200))
        for _ in range(rng.randint(0, 3)):
            x = rng.choice(every).split()
            for _ in range(rng.randint(0, 2)):
                x[rng.randrange(len(x))] = "zzz"
            t += "\n" + " ".join(x) + "\n" + filler(rng.randint(0, 60))
        out.append(t)
    return out


def test_band_settings():
    assert lc.collision(lc.worst_jaccard()) > 0.999


def test_matches_brute_force():
    texts = cases()
    t = lc.Templates(lc.TEMPLATES)
    got = lc.find(t, column_bytes(pa.array(texts)))
    found = {i: {t.names[x]: round(v[0], 9) for (d, x), v in got.items() if d == i} for i in range(len(texts))}
    want = {i: {k: round(v, 9) for k, v in brute(x).items()} for i, x in enumerate(texts)}
    assert found == want


def test_table(spark):
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(cases(30))] + [(None, "All rights reserved.", 1.0)], "doc_id long, text string, containment double")
    got = lc.licenses(df).collect()
    assert (None, "all-rights-reserved") in {(r.doc_id, r.license) for r in got}
    assert all(r.containment >= 0.8 and r.n_matches >= 1 and 0 <= r.first_word < r.last_word for r in got)
    assert lc.licenses(df.limit(0)).count() == 0
