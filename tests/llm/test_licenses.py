"""License scans against a plain reading of the contract and of the rules."""
import random
import re

from shelfspark.llm import licenses

SCHEMA = "doc_id long, text string, labels int"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def base(t):
    words = re.findall(WORD, lower(t))
    places, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def detections(t):
    """Labels by running every rule everywhere and comparing all intervals."""
    t, found = lower(t), []
    for number, label, tier, keyword, expression in licenses.rules():
        for m in re.finditer(expression, t):
            assert keyword in m.group() and any(w in m.group() for w in licenses.FIRST_LOOK), expression
            found.append((tier, number, m.start(), m.end(), label))
    kept = set()
    for a in found:
        def contains(b):
            same = (b[2], b[3]) == (a[2], a[3])
            return b[2] <= a[2] and b[3] >= a[3] and b[0] <= a[0] and (not same or (b[0], b[1]) < (a[0], a[1]))
        if not any(contains(b) for b in found):
            kept.add(a[4])
    return kept, len(found)


TEXTS = [None, "", "no words about it", "MIT License", "the mit\tLICENSE, mit license. Apache--License 2.0", "mit licenseé mit licensee xmit license",
         "GNU General Public License, version 3 or GPLv2 or later; LGPL v2.1", "gnu lesser general public license version 2.1",
         "SPDX-License-Identifier: Apache-2.0\n// SPDX-License-Identifier: MIT", "licensed under CC BY-NC-SA 4.0 and cc0", "İMIT license",
         "released under the mit license", "licensed under the apache license, version 2.0", "K mit license \U0001F600 mit license",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mpl-2.0 licensed",
         "Redistribution and use in source and binary forms, with or without modification, are permitted",
         "this is free and unencumbered software released into the public domain. unlicense", "mit license " * 3000, "x " * 30_000 + "gnu general public license"]


def sample(expression, rng):
    """A text that an expression matches: groups and choices taken as written, separators varied."""
    t = expression.replace(f"(?<!{licenses.WORD})", "").replace(f"(?!{licenses.WORD})", "").replace(r"(?![a-z0-9.\-+])", "")
    t = t.replace(r"(?:\S+\s+){1,12}?", "its authors ").replace(r"[\x20\-]", "-").replace(r":\s*", ": ")
    t = t.replace(licenses.GAP + "?", " ").replace(licenses.GAP, rng.choice([" ", "\n", ", "])).replace("[cs]", "s").replace("[abc]", "b")
    t = re.sub(r"\[([^\]])[^\]]*\]", r"\1", t)
    for _ in range(6):
        t = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", t)
    t = t.replace("?", "").replace("\\", "")
    assert re.search(expression, t), (expression, t)
    return t


def test_rules_are_many_and_name_their_keyword():
    found = licenses.rules()
    assert len(found) > 300 and len({r[0] for r in found}) == len(found)
    assert [r[2] for r in found] == sorted(r[2] for r in found)


def test_scan_matches_plain_reading(spark):
    rng = random.Random(9)
    texts = list(TEXTS) + [t.replace(" ", gap) for t in TEXTS[3:18] for gap in ("\n", " -- ", "_")]
    texts += [sample(r[4], rng) for r in licenses.rules()]
    for _ in range(60):
        texts.append(" ".join(rng.choice([t for t in TEXTS[:17] if t] + ["filler words", "das ist mit", "license"]) for _ in range(rng.randrange(1, 5))))
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, "MIT License", 1), (None, "isc license", 1)]
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, t, _ in rows:
        r = by[i][0]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t), t
        if t is None or len(t) < 5000:
            own, n = detections(t)
            assert r.labels == ",".join(sorted(own | set(r.base_labels.split(",")) - {""})), t
            assert (r.score > 0) == bool(n)
        assert 0 <= r.score <= 1


def test_containment(spark):
    data = [(1, 0, "a", 3, 0, 10), (1, 1, "b", 3, 2, 8), (1, 2, "c", 2, 2, 8), (1, 3, "d", 4, 0, 10), (1, 4, "e", 4, 5, 12), (2, 1, "b", 3, 2, 8)]
    df = spark.createDataFrame(data, "row long, rule int, label string, tier int, start long, stop long")
    assert sorted((r.row, r.label) for r in licenses._kept(df).collect()) == [(1, "a"), (1, "c"), (1, "e"), (2, "b")]


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


SPELLINGS = [  # rules with an optional blank: fused and separated spelling, label
    ("gplv2 only", "gpl v2 only", "gpl-2.0"), ("gpl2", "GPL 2", "gpl-2.0"), ("GPLv3", "gpl, v3", "gpl-3.0"),
    ("gplv2 or later", "gpl v2 or any later", "gpl-2.0-or-later"), ("gpl3 or later", "gpl 3 or later", "gpl-3.0-or-later"),
    ("LGPLv2.1", "lgpl v2.1", "lgpl-2.1"), ("lgpl3", "lgpl 3.0", "lgpl-3.0"), ("AGPLv3", "agpl v3", "agpl-3.0"),
    ("mplv2 license", "mpl v2.0 license", "mpl-2.0"),
    ("creative commons attribution-sharealike license", "creative commons attribution share-alike", "cc-by-sa"),
    ("Creative Commons Attribution-NoDerivatives", "creative commons attribution no derivatives", "cc-by-nd"),
    ("creative commons attribution-noncommercial license", "creative commons attribution non-commercial", "cc-by-nc"),
    ("creative commons attribution-noncommercial-sharealike", "creative commons attribution non-commercial share alike", "cc-by-nc-sa"),
    ("creative commons attribution-noncommercial-noderivatives", "creative commons attribution non commercial no derivatives", "cc-by-nc-nd"),
    ("beerware license", "beer-ware license", "beerware"), ("openrail-m license", "open rail m license", "openrail")]


def test_optional_blanks(spark):
    written = [line.split(" | ", 3) for line in licenses.RULES.strip().splitlines() if " ?" in line]
    assert {w[0] for w in written} == {s[2] for s in SPELLINGS}
    for label, _, _, expression in written:  # every such rule matches with and without the blank
        bounded = re.compile(licenses._bounded(expression))
        for side in (0, 1):
            assert any(bounded.search(lower(s[side])) for s in SPELLINGS if s[2] == label), (label, expression, side)
    texts = [s[side] for s in SPELLINGS for side in (0, 1)]
    got = licenses.scan(spark.createDataFrame([(i, f"see the {t} here", 1) for i, t in enumerate(texts)], SCHEMA)).collect()
    for r in got:
        assert r.labels == SPELLINGS[r.doc_id // 2][2], (texts[r.doc_id], r.labels)
