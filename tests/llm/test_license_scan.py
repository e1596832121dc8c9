import random
import re
import re._parser as sre

from tessera.llm import license_scan as L
from tessera.llm.license_rules import BASE, KINDS, load

TEXTS = [
    (1, "Released under the MIT License."),
    (2, "x GNU  General-Public\nLicense y. Licensed under the Apache License, Version 2.0. CC BY-NC 4.0 mit License MIT LICENSE"),
    (3, None),
    (4, ""),
    (5, "Der Hund mit cc-by. CC BYE ccby élicense mit licensé"),
    (None, "SPDX-License-Identifier: MIT\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    (7, "mit license " * 400),
    (1, "Released under the MIT License."),
    (8, "https://www.apache.org/licenses/LICENSE-2.0 gnu general public license general public license"),
]


def brute(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    hits = [(i, lab) for p, lab in BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    # every rule over the plain words, no prefilter; then suppression pair by pair
    line, found = " " + " ".join(w) + " ", []
    for n, (kind, label, pat) in enumerate(load()):
        for m in re.finditer("(?<= )(?:" + pat.replace("( \\w+)", "( [^ ]+)") + ")(?= )", line):
            s = line[: m.start()].count(" ") - 1
            found.append((s, s + len(m.group().split()), KINDS[kind][0], n, label))
    kept = []
    for d in found:
        beaten = any(
            e is not d and e[0] <= d[0] and e[1] >= d[1] and (e[2] > d[2] or e[2] == d[2] and (e[1] - e[0] > d[1] - d[0] or e[1] - e[0] == d[1] - d[0] and e[3] < d[3])) for e in found
        )
        if not beaten:
            kept.append(d)
    labels = {d[4] for d in kept} | {x[1] for x in hits}
    starts = [x[0] for x in hits]
    return (len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x[1] for x in hits})), ",".join(sorted(labels)))


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "w") for i, t in TEXTS], "doc_id long, text string, line string")
    got = sorted((tuple(r)[:7] for r in L.license_report(df).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in TEXTS), key=repr)
    assert all(0 <= r.score <= 1 for r in L.license_report(df).collect())


def made(items, rnd):
    """A text that the parsed pattern matches."""
    out = []
    for op, arg in items:
        if op is sre.LITERAL:
            out.append(chr(arg))
        elif op is sre.IN:
            op, x = rnd.choice(arg)
            out.append(chr(x) if op is sre.LITERAL else rnd.choice("123") if x is sre.CATEGORY_DIGIT else rnd.choice("xyz"))
        elif op is sre.SUBPATTERN:
            out.append(made(arg[3], rnd))
        elif op is sre.BRANCH:
            out.append(made(rnd.choice(arg[1]), rnd))
        else:
            low, high, sub = arg
            out += [made(sub, rnd) for _ in range(rnd.randint(low, min(high, low + 3)))]
    return "".join(out)


def test_no_rule_loses_a_match_to_its_keywords_or_the_stems(spark):
    rnd = random.Random(7)
    assert len(load()) > 200
    texts = []
    for kind, label, pattern in load():
        held = L.keywords(pattern)
        assert 0 < len(held) <= L.ALTERNATIVES and all(any(s in k for s in L.STEMS) for k in held)
        for _ in range(12):
            t = made(sre.parse(pattern).data, rnd)
            assert re.fullmatch(pattern, t) and any(k in f" {t} " for k in held), (pattern, t)
        texts += [f"q {t}, Q!", f"Q.{t.upper()}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r)[:7] for r in L.license_report(df).collect())
    assert got == [(i, *brute(t)) for i, t in enumerate(texts)]


def test_probe_texts(spark):
    probes = ["Released under the Expat License.", "Licensed under the PSF License", "do what the fuck you want to public license", "as long as you retain this notice you can do whatever you want with this stuff",
              "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.", "Licensed under the EUPL, version 1.2", "released under the GNU Library General Public License"]
    want = ["mit", "python-2.0", "wtfpl", "beerware", "gpl", "eupl-1.2", "lgpl"]
    df = spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string")
    assert [r.labels for r in L.license_report(df).orderBy("doc_id").collect()] == want


def test_empty(spark):
    assert L.license_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
