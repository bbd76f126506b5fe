"""License scans by ordered signature rules, with DataFrame functions only.

A rule is a regular expression with a label, a tier (1 is the strongest
evidence) and a keyword that every match contains. The keyword is searched
first; only rules whose keyword occurs in a text run on it. Matches become
intervals, and an interval is suppressed when one of the same or a stronger
tier contains it, so ``GNU Lesser General Public License, version 2.1`` is
one detection and not also ``General Public License``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAYBE_GAP = GAP[:-1] + "*"

# Phrases of the contract and their labels (fixed values).
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Every rule's matches contain one of these; a text without any is done after this look.
FIRST_LOOK = ("licen", "gpl", "copyright", "copyleft", "domain", "permission", "redistribut", "commons", "warrant", "reserved",
              "cc0", "cc by", "cc-by", "gfdl", "wtfpl", "endorse", "advertising", "evil", "perl", "nasa", "rail", "clause",
              "attribution", "mozilla", "eclipse")

CONFIDENCE = {1: 0.99, 2: 0.95, 3: 0.85, 4: 0.6}

# label | tier | keyword | expression over lower-cased text. A blank in an expression stands for any
# separators between words and `` ?`` for any or none; expressions match at word boundaries.
RULES = r"""
mit | 3 | mit | (?:the )?mit licen[cs]e
mit | 3 | mit | licen[cs]ed under (?:the )?(?:terms of (?:the )?)?mit
mit | 3 | mit | released under (?:the )?mit licen[cs]e
mit | 3 | mit | distributed under (?:the )?mit licen[cs]e
mit | 4 | mit | mit licen[cs]ed
mit | 4 | mit | mit style licen[cs]e
mit | 2 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 2 | permission | the above copyright notice and this permission notice shall be included in all copies
mit | 2 | opensource | opensource org licenses mit
x11 | 3 | x11 | x11 licen[cs]e
expat | 3 | expat | expat licen[cs]e
mit-0 | 3 | attribution | mit no attribution(?: licen[cs]e)?
isc | 3 | isc | (?:the )?isc licen[cs]e
isc | 2 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee
isc | 2 | opensource | opensource org licenses isc
apache | 3 | apache | (?:the )?apache licen[cs]e
apache | 3 | apache | apache software licen[cs]e
apache-1.0 | 3 | apache | apache (?:software )?licen[cs]e (?:version |v )?v?1 0
apache-1.1 | 3 | apache | apache (?:software )?licen[cs]e (?:version |v )?v?1 1
apache-2.0 | 3 | apache | (?:the )?apache (?:software )?licen[cs]e (?:version |v )?v?2(?: 0)?
apache-2.0 | 3 | apache | licen[cs]ed under (?:the )?apache (?:software )?licen[cs]e (?:version |v )?v?2(?: 0)?
apache-2.0 | 2 | apache | licen[cs]ed to the apache software foundation
apache-2.0 | 2 | apache | apache org licenses license 2 0
apache-2.0 | 4 | apache | apache v?2(?: 0)? licen[cs]e
apache-2.0 | 4 | asl | asl v?2(?: 0)? licen[cs]e
apache-2.0 | 2 | compliance | you may not use this file except in compliance with the licen[cs]e
apache-2.0 | 2 | warrant | distributed on an as is basis without warranties or conditions of any kind
bsd | 3 | bsd | (?:the )?bsd licen[cs]e
bsd | 4 | bsd | bsd style licen[cs]e
bsd | 4 | bsd | bsd licen[cs]ed
bsd-0-clause | 3 | bsd | (?:0|zero) clause bsd(?: licen[cs]e)?
bsd-1-clause | 3 | bsd | (?:1|one) clause bsd(?: licen[cs]e)?
bsd-2-clause | 3 | bsd | (?:(?:2|two) clause|simplified|freebsd) bsd(?: licen[cs]e)?
bsd-2-clause | 3 | bsd | bsd (?:2|two) clause(?: licen[cs]e)?
bsd-2-clause | 3 | freebsd | freebsd licen[cs]e
bsd-3-clause | 3 | bsd | (?:(?:3|three) clause|new|revised|modified) bsd(?: licen[cs]e)?
bsd-3-clause | 3 | bsd | bsd (?:3|three) clause(?: licen[cs]e)?
bsd-3-clause | 2 | endorse | neither the name of (?:the )?(?:\S+\s+){1,12}?may be used to endorse or promote products
bsd-4-clause | 3 | bsd | (?:(?:4|four) clause|original|old) bsd(?: licen[cs]e)?
bsd-4-clause | 3 | bsd | bsd (?:4|four) clause(?: licen[cs]e)?
bsd-4-clause | 2 | advertising | all advertising materials mentioning features or use of this software must display
bsd | 2 | redistribut | redistribution and use in source and binary forms with or without modification are permitted
bsd | 2 | redistribut | redistributions of source code must retain the above copyright notice
bsd | 2 | redistribut | redistributions in binary form must reproduce the above copyright notice
gpl | 3 | general | (?:the )?(?:gnu )?general public licen[cs]e
gpl | 3 | general | licen[cs]ed under (?:the )?(?:terms of (?:the )?)?(?:gnu )?general public licen[cs]e
gpl-1.0 | 3 | general | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version |v )v?1(?: 0)?
gpl-2.0 | 3 | general | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version |v )v?2(?: 0)?
gpl-3.0 | 3 | general | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version |v )v?3(?: 0)?
gpl-2.0 | 3 | gpl | (?:gnu )?gpl ?v?(?:ersion )?2(?: 0)?(?: only)?
gpl-3.0 | 3 | gpl | (?:gnu )?gpl ?v?(?:ersion )?3(?: 0)?(?: only)?
gpl-2.0-or-later | 3 | gpl | (?:gnu )?gpl ?v?2(?: 0)? or (?:any )?later
gpl-3.0-or-later | 3 | gpl | (?:gnu )?gpl ?v?3(?: 0)? or (?:any )?later
gpl-2.0-or-later | 3 | general | general public licen[cs]e(?: as published by the free software foundation)? either version 2 of the licen[cs]e or at your option any later version
gpl-3.0-or-later | 3 | general | general public licen[cs]e(?: as published by the free software foundation)? either version 3 of the licen[cs]e or at your option any later version
gpl | 4 | gpl | (?:gnu )?gpl licen[cs]ed?
gpl | 4 | gpl | under (?:the )?(?:gnu )?gpl
gpl | 2 | gnu | gnu org (?:licenses|copyleft) gpl
gpl | 2 | redistribut | this program is free software you can redistribute it and or modify it
gpl-with-classpath-exception | 3 | classpath | (?:gpl|general public licen[cs]e)(?: version| v)?(?: 2)? with (?:the )?classpath exception
lgpl | 3 | lesser | (?:the )?(?:gnu )?lesser general public licen[cs]e
lgpl | 3 | library | (?:the )?(?:gnu )?library general public licen[cs]e
lgpl-2.0 | 3 | library | (?:gnu )?library general public licen[cs]e (?:version |v )v?2(?: 0)?
lgpl-2.1 | 3 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v )v?2 1
lgpl-3.0 | 3 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v )v?3(?: 0)?
lgpl-2.1 | 3 | lgpl | (?:gnu )?lgpl ?v?2 1
lgpl-3.0 | 3 | lgpl | (?:gnu )?lgpl ?v?3(?: 0)?
lgpl | 4 | lgpl | (?:gnu )?lgpl licen[cs]ed?
lgpl | 4 | lgpl | under (?:the )?(?:gnu )?lgpl
lgpl | 2 | gnu | gnu org (?:licenses|copyleft) lgpl
agpl | 3 | affero | (?:the )?(?:gnu )?affero general public licen[cs]e
agpl-3.0 | 3 | affero | (?:gnu )?affero general public licen[cs]e (?:version |v )v?3(?: 0)?
agpl-3.0 | 3 | agpl | (?:gnu )?agpl ?v?3(?: 0)?
agpl | 4 | agpl | under (?:the )?(?:gnu )?agpl
agpl | 2 | gnu | gnu org licenses agpl
gfdl | 3 | documentation | (?:gnu )?free documentation licen[cs]e
gfdl-1.2 | 3 | documentation | (?:gnu )?free documentation licen[cs]e (?:version |v )1 2
gfdl-1.3 | 3 | documentation | (?:gnu )?free documentation licen[cs]e (?:version |v )1 3
gfdl | 4 | gfdl | under (?:the )?(?:gnu )?gfdl
gfdl | 2 | gnu | gnu org (?:licenses|copyleft) fdl
mpl | 3 | mozilla | mozilla public licen[cs]e
mpl-1.0 | 3 | mozilla | mozilla public licen[cs]e (?:version |v )v?1 0
mpl-1.1 | 3 | mozilla | mozilla public licen[cs]e (?:version |v )v?1 1
mpl-2.0 | 3 | mozilla | mozilla public licen[cs]e (?:version |v )v?2(?: 0)?
mpl-2.0 | 2 | mozilla | mozilla org mpl 2 0
mpl-2.0 | 4 | mpl | mpl ?v?2(?: 0)? licen[cs]ed?
mpl | 2 | mozilla | this source code form is subject to the terms of the mozilla public licen[cs]e
epl | 3 | eclipse | eclipse public licen[cs]e
epl-1.0 | 3 | eclipse | eclipse public licen[cs]e (?:version |v )?v?1(?: 0)?
epl-2.0 | 3 | eclipse | eclipse public licen[cs]e (?:version |v )?v?2(?: 0)?
epl | 2 | eclipse | eclipse org (?:legal )?epl
edl-1.0 | 3 | eclipse | eclipse distribution licen[cs]e
cddl | 3 | development | common development and distribution licen[cs]e
cddl-1.0 | 3 | development | common development and distribution licen[cs]e (?:cddl )?(?:version |v )?v?1 0
cddl-1.1 | 3 | development | common development and distribution licen[cs]e (?:cddl )?(?:version |v )?v?1 1
cpl-1.0 | 3 | common | common public licen[cs]e(?: version)?(?: 1 0)?
cpal-1.0 | 3 | attribution | common public attribution licen[cs]e
ipl-1.0 | 3 | ibm | ibm public licen[cs]e
eupl | 3 | european | european union public licen[cs]e
eupl-1.1 | 3 | european | european union public licen[cs]e (?:eupl )?(?:version |v )?v?1 1
eupl-1.2 | 3 | european | european union public licen[cs]e (?:eupl )?(?:version |v )?v?1 2
cecill | 3 | cecill | cecill(?: [abc])?(?: free software)? licen[cs]e
artistic | 3 | artistic | (?:the )?artistic licen[cs]e
artistic-1.0 | 3 | artistic | artistic licen[cs]e (?:version |v )?1 0
artistic-2.0 | 3 | artistic | artistic licen[cs]e (?:version |v )?2(?: 0)?
perl | 4 | perl | same terms as perl(?: itself)?
bsl-1.0 | 3 | boost | boost software licen[cs]e(?: version)?(?: 1 0)?
bsl-1.0 | 2 | boost | boost org license 1 0 txt
busl-1.1 | 3 | business | business source licen[cs]e(?: version)?(?: 1 1)?
zlib | 3 | zlib | (?:the )?zlib(?: libpng)? licen[cs]e
zlib | 2 | warrant | this software is provided as is without any express or implied warranty
libpng | 3 | libpng | libpng licen[cs]e
unlicense | 3 | unlicense | (?:the )?unlicense
unlicense | 2 | domain | this is free and unencumbered software released into the public domain
wtfpl | 3 | fuck | do what the fuck you want to public licen[cs]e
wtfpl | 4 | wtfpl | wtfpl(?: licen[cs]ed?)?
cc0-1.0 | 3 | cc0 | cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?
cc0-1.0 | 3 | commons | creative commons zero(?: v?1 0)?(?: universal)?
cc0-1.0 | 2 | creativecommons | creativecommons org publicdomain zero
cc-pdm | 2 | creativecommons | creativecommons org publicdomain mark
public-domain | 4 | domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 4 | domain | in the public domain
cc-by | 3 | commons | creative commons attribution(?: licen[cs]e)?
cc-by-sa | 3 | commons | creative commons attribution share ?alike(?: licen[cs]e)?
cc-by-nd | 3 | commons | creative commons attribution no ?derivatives(?: licen[cs]e)?
cc-by-nc | 3 | commons | creative commons attribution non ?commercial(?: licen[cs]e)?
cc-by-nc-sa | 3 | commons | creative commons attribution non ?commercial share ?alike(?: licen[cs]e)?
cc-by-nc-nd | 3 | commons | creative commons attribution non ?commercial no ?derivatives(?: licen[cs]e)?
cc | 4 | commons | (?:under (?:a |the )?)?creative commons licen[cs]e
ofl | 3 | font | (?:sil )?open font licen[cs]e
ofl-1.1 | 3 | font | (?:sil )?open font licen[cs]e (?:version |v )?1 1
odbl-1.0 | 3 | database | open (?:data commons open )?database licen[cs]e
odc-by-1.0 | 3 | commons | open data commons attribution licen[cs]e
pddl-1.0 | 3 | commons | open data commons public domain dedication and licen[cs]e
openssl | 3 | openssl | openssl licen[cs]e
ssleay | 3 | ssleay | (?:original )?ssleay licen[cs]e
psf-2.0 | 3 | python | python(?: software foundation)? licen[cs]e
psf-2.0 | 3 | psf | psf(?: software foundation)? licen[cs]e
php | 3 | php | (?:the )?php licen[cs]e
php-3.01 | 3 | php | php licen[cs]e (?:version |v )?3 01
ruby | 3 | ruby | ruby licen[cs]e
postgresql | 3 | postgresql | (?:the )?postgresql licen[cs]e
tcl | 3 | tcl | tcl(?: tk)? licen[cs]e
vim | 3 | vim | vim licen[cs]e
curl | 3 | curl | curl licen[cs]e
ncsa | 3 | illinois | university of illinois(?: ncsa)? open source licen[cs]e
w3c | 3 | w3c | w3c software(?: notice and)?(?: and document)? licen[cs]e
zpl | 3 | zope | zope public licen[cs]e
qpl-1.0 | 3 | public | q public licen[cs]e
osl-3.0 | 3 | software | open software licen[cs]e(?: v?3(?: 0)?)?
afl-3.0 | 3 | academic | academic free licen[cs]e(?: v?3(?: 0)?)?
ecl-2.0 | 3 | educational | educational community licen[cs]e
ms-pl | 3 | microsoft | microsoft public licen[cs]e
ms-rl | 3 | microsoft | microsoft reciprocal licen[cs]e
upl-1.0 | 3 | permissive | universal permissive licen[cs]e
sspl-1.0 | 3 | server | server side public licen[cs]e
elastic-2.0 | 3 | elastic | elastic licen[cs]e(?: v?2(?: 0)?)?
commons-clause | 3 | clause | commons clause(?: licen[cs]e condition)?
blueoak-1.0.0 | 3 | oak | blue oak model licen[cs]e
mulan-psl | 3 | mulan | mulan (?:permissive software|psl)(?: v?[12])? licen[cs]e
beerware | 3 | beer | beer ?ware licen[cs]e
json | 3 | json | json licen[cs]e
json | 2 | evil | the software shall be used for good not evil
hpnd | 3 | historical | historical permission notice and disclaimer
naist | 3 | naist | naist licen[cs]e
sleepycat | 3 | sleepycat | sleepycat licen[cs]e
sissl | 3 | industry | sun industry standards source licen[cs]e
apsl | 3 | apple | apple public source licen[cs]e
rpl | 3 | reciprocal | reciprocal public licen[cs]e
nasa-1.3 | 3 | nasa | nasa open source agreement
openrail | 3 | rail | (?:creativeml )?open ?rail(?: m)?(?: licen[cs]e)?
llama | 3 | llama | llama(?: [23])?(?: community)? licen[cs]e
proprietary | 4 | reserved | all rights reserved
proprietary | 3 | proprietary | proprietary (?:and confidential )?licen[cs]e
proprietary | 4 | permission | without (?:the )?(?:prior )?written permission of
shareware | 4 | shareware | shareware licen[cs]e
copyleft | 4 | copyleft | copyleft licen[cs]e
permissive | 4 | permissive | permissive (?:free software )?licen[cs]e
"""

# Short forms of the Creative Commons family, by element and version.
CC_ELEMENTS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
# Identifiers that may follow an SPDX tag, each a rule of its own.
SPDX = """0bsd afl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-1.0 artistic-2.0 blueoak-1.0.0
bsd-2-clause bsd-3-clause bsd-4-clause bsl-1.0 busl-1.1 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0
cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpl-1.0 curl ecl-2.0 epl-1.0 epl-2.0 eupl-1.1
eupl-1.2 gfdl-1.3-only gpl-1.0-only gpl-2.0-only gpl-2.0-or-later gpl-3.0-only gpl-3.0-or-later isc lgpl-2.0-only
lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0-only lgpl-3.0-or-later libpng-2.0 mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl ncsa
odbl-1.0 ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0 ruby sspl-1.0 unicode-3.0 unlicense upl-1.0 vim
w3c wtfpl x11 zlib zpl-2.1""".split()


def _bounded(expression: str) -> str:
    spaced = expression.replace(" ?", MAYBE_GAP).replace(" ", GAP)  # a question mark behind GAP would make it reluctant
    return f"(?<!{WORD})(?:{spaced})(?!{WORD})"


def rules() -> list[tuple[int, str, int, str, str]]:
    """``(number, label, tier, keyword, expression)``, strongest tier first, then as written."""
    found = []
    for line in RULES.strip().splitlines():
        label, tier, keyword, expression = (p.strip() for p in line.split(" | ", 3))
        found.append((label, int(tier), keyword, _bounded(expression)))
    for e in CC_ELEMENTS:
        words = e.replace("-", " ")
        found.append((f"cc-{e}", 3, "cc", _bounded(rf"cc[\x20\-]{words}")))
        for v in CC_VERSIONS:
            major = v.replace(".0", "(?: 0)?").replace(".5", " 5")
            found.append((f"cc-{e}-{v}", 3, "cc", _bounded(rf"cc[\x20\-]{words} {major}")))
            found.append((f"cc-{e}-{v}", 2, "creativecommons", _bounded(f"creativecommons org licenses {words} {v.replace('.', ' ')}")))
    for s in SPDX:
        exact = s.replace(".", r"\.").replace("-", r"\-")
        found.append((s, 1, "spdx", rf"(?<!{WORD})spdx\-license\-identifier:\s*{exact}(?![a-z0-9.\-+])"))
    ordered = sorted(found, key=lambda r: r[1])
    return [(i, *r) for i, r in enumerate(ordered)]


def _lower(col):
    return F.translate(F.coalesce(col, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _any(col, words):
    found = F.lit(False)
    for w in words:
        found = found | F.contains(col, F.lit(w))
    return found


def _texts(docs: DataFrame) -> DataFrame:
    """Per row: counts and base phrases of the whole text, and the text itself only where a rule may match."""
    t = F.col("t")
    phrases = [(_bounded(p), label) for p, label in BASE]
    either = "|".join(p for p, _ in phrases)
    rows = docs.select("doc_id", _lower(F.col("text")).alias("t"))
    rows = rows.withColumn("maybe", F.contains(t, F.lit("license")))
    for i, (p, _) in enumerate(phrases):
        rows = rows.withColumn(f"n{i}", F.when(F.col("maybe"), F.regexp_count(t, F.lit(p))).otherwise(0).cast("long"))
    places = sum((F.col(f"n{i}") for i in range(len(phrases))), F.lit(0).cast("long"))
    before = lambda dots: F.regexp_count(F.regexp_extract(t, rf"(?s)^({dots})(?:{either})", 1), F.lit(f"{WORD}+")).cast("long")
    labels = F.array_compact(F.array(*[F.when(F.col(f"n{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]))
    return rows.withColumn("n_base", places).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.regexp_count(t, F.lit(f"{WORD}+")).cast("long").alias("n_words"),
        "n_base", F.when(F.col("n_base") > 0, before(".*?")).alias("first_word"),
        F.when(F.col("n_base") > 0, before(".*")).alias("last_word"),
        F.array_sort(labels).alias("base"), F.when(_any(t, FIRST_LOOK), t).alias("t"))


def _detections(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """``row, rule, label, tier, start, stop`` of every match of every rule, in characters."""
    table = spark.createDataFrame(rules(), "rule int, label string, tier int, keyword string, expression string")
    keywords = sorted({r[3] for r in rules()})
    present = F.array_compact(F.array(*[F.when(F.contains("t", F.lit(k)), F.lit(k)) for k in keywords]))
    gated = texts.where(F.col("t").isNotNull()).select("row", "t", F.explode(present).alias("keyword"))
    hits = gated.join(F.broadcast(table), "keyword").where(F.expr("t RLIKE expression"))  # a fixed table of rules
    cut = hits.select("row", "rule", "label", "tier", F.posexplode(F.arrays_zip(
        F.expr("transform(split(t, expression), x -> length(x))").alias("gap"),
        F.expr("transform(regexp_extract_all(t, expression, 0), x -> length(x))").alias("size"))).alias("at", "m")) \
        .select("row", "rule", "label", "tier", "at", F.col("m.gap").cast("long").alias("gap"), F.col("m.size").cast("long").alias("size"))
    upto = Window.partitionBy("row", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(upto) - F.coalesce("size", F.lit(0))
    return cut.withColumn("start", start).where(F.col("size").isNotNull()) \
              .select("row", "rule", "label", "tier", "start", (F.col("start") + F.col("size")).alias("stop"))


def _kept(detections: DataFrame) -> DataFrame:
    """Detections that no other of the same or a stronger tier contains; of equal intervals the first rule's stays."""
    earlier = Window.partitionBy("row").orderBy("start", F.desc("stop"), "tier", "rule").rowsBetween(Window.unboundedPreceding, -1)
    marked = detections
    for k in CONFIDENCE:
        marked = marked.withColumn(f"reach{k}", F.max(F.when(F.col("tier") <= k, F.col("stop"))).over(earlier))
    reach = F.coalesce(*[F.when(F.col("tier") == k, F.col(f"reach{k}")) for k in CONFIDENCE])
    return marked.where(reach.isNull() | (reach < F.col("stop")))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words, places and labels are those of the contract over the whole
    lower-cased text; labels adds those of kept detections; score is the
    largest confidence of a kept detection or base phrase, else 0. Null texts
    count as empty; null doc_ids and repeated rows come back as they are; extra
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = stored(_texts(docs), "license-texts")
    kept = _kept(_detections(spark, texts))
    confidence = F.coalesce(*[F.when(F.col("tier") == k, F.lit(v)) for k, v in CONFIDENCE.items()])
    found = kept.groupBy("row").agg(F.collect_set("label").alias("own"), F.max(confidence).alias("score"),
                                    F.count("*").alias("n_detections"))
    none = F.array().cast("array<string>")
    base_score = F.when(F.col("n_base") > 0, F.lit(CONFIDENCE[3])).otherwise(0.0)
    return texts.drop("t").join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("own", none))), ",").alias("labels"),
        F.greatest(F.coalesce("score", F.lit(0.0)), base_score).alias("score"),
        F.coalesce("n_detections", F.lit(0).cast("long")).alias("n_detections"))
