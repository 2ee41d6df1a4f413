"""License scan with ordered signature rules, in DataFrame functions only.

A text becomes its words, lower-cased and joined by single spaces. A rule's regex runs
only on texts that hold its keyword. Each detection is a word interval with the rule's
tier and order; one that lies inside another of the same or a stronger tier, or that a
stronger one reaches into from before, is suppressed. All of it happens inside the row:
nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.llm.common import table

APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases: counted as they stand, before any suppression.
BASE = """
cc-by    | 1 | cc       | cc by
gpl      | 1 | general  | general public license
reserved | 2 | reserved | all rights reserved
"""

# label | tier (0 full name with version or notice, 1 name, 2 hint) | keywords, one of
# which every match holds as a word (* for the start of one) | regex over words; before a
# number, "( version)?" also stands for " v2", " version v2" and a v joined to the name. The order of the lines is the priority among equal intervals.
SIGNATURES = """
apache-2.0 | 0 | apache | (licensed under the )?apache license( version)? 2( 0)?
apache-2.0 | 0 | apache | apache( software)? licen[cs]e( version)? 2( 0)?
apache-2.0 | 0 | apache* | apache( version)? 2( 0)? licen[cs]e
apache-2.0 | 0 | apache | apache org licenses license 2 0
apache-1.1 | 0 | apache | apache( software)? licen[cs]e( version)? 1 1
apache-1.0 | 0 | apache | apache( software)? licen[cs]e( version)? 1 0
apache | 1 | apache | apache( software)? licen[cs]e
mit | 0 | mit | (released|licensed|distributed|available) under( the)?( terms of the)? mit( x11)? licen[cs]e
mit | 0 | permission | permission is hereby granted free of charge to any person obtaining a copy
mit | 1 | mit | (the )?mit( x11| expat)? licen[cs]e
mit-0 | 0 | mit | mit no attribution
x11 | 0 | x11 | x11 licen[cs]e
expat | 0 | expat | expat licen[cs]e
isc | 0 | isc | (the )?isc licen[cs]e
isc | 0 | permission | permission to use copy modify and or distribute this software for any purpose
0bsd | 0 | bsd/0bsd | (zero clause bsd|0bsd|bsd zero clause)( licen[cs]e)?
bsd-2-clause | 0 | bsd | (2|two) clause( simplified)? bsd( licen[cs]e)?
bsd-2-clause | 0 | bsd | bsd 2 clause( simplified)?( licen[cs]e)?
bsd-2-clause | 0 | bsd | simplified bsd licen[cs]e
bsd-3-clause | 0 | bsd | (3|three) clause bsd( licen[cs]e)?
bsd-3-clause | 0 | bsd | bsd 3 clause( new or revised)?( licen[cs]e)?
bsd-3-clause | 0 | bsd | (new|revised|modified) bsd licen[cs]e
bsd-3-clause | 0 | neither | neither the name of .{1,80} nor the names of its contributors
bsd-4-clause | 0 | bsd | (4|four) clause bsd( licen[cs]e)?
bsd-4-clause | 0 | bsd | (original|old) bsd licen[cs]e
bsd-4-clause | 0 | advertising | all advertising materials mentioning features or use of this software
bsd | 0 | redistribution | redistribution and use in source and binary forms with or without modification
bsd | 1 | bsd | bsd( style)? licen[cs]e
unlicense | 0 | unlicense | (the )?unlicense
unlicense | 0 | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 0 | wtfpl | wtfpl
wtfpl | 0 | fuck | do what the fuck you want to public license
zlib | 0 | zlib | zlib( libpng)? licen[cs]e
libpng | 0 | libpng | libpng licen[cs]e( version)?( 2)?
boost-1.0 | 0 | boost | boost software licen[cs]e( version)?( 1 0)?
artistic-1.0 | 0 | artistic | (clarified )?artistic licen[cs]e( version)? 1 0
artistic-2.0 | 0 | artistic | artistic licen[cs]e( version)? 2 0
artistic | 1 | artistic | artistic licen[cs]e
perl | 0 | perl | same terms as perl itself
python-2.0 | 0 | python/psf | (python|psf) licen[cs]e( version)? 2
python | 1 | python | python( software foundation)? licen[cs]e
ruby | 1 | ruby | ruby licen[cs]e
php-3.01 | 0 | php | php licen[cs]e( version)? 3 01
php-3.0 | 0 | php | php licen[cs]e( version)? 3 0
php | 1 | php | php licen[cs]e
openssl | 0 | openssl | openssl licen[cs]e
openssl | 0 | openssl | developed by the openssl project
ssleay | 0 | ssleay | (original )?ssleay licen[cs]e
postgresql | 0 | postgresql | postgresql licen[cs]e
sleepycat | 0 | sleepycat | sleepycat licen[cs]e
beerware | 0 | beer/beerware | beer ?ware licen[cs]e
vim | 0 | vim | vim licen[cs]e
curl | 0 | curl | curl licen[cs]e
ijg | 0 | independent | independent jpeg group
ncsa | 0 | ncsa | (university of illinois )?ncsa( open source)? licen[cs]e
ms-pl | 0 | microsoft | microsoft public licen[cs]e
ms-rl | 0 | microsoft | microsoft reciprocal licen[cs]e
ms-limited | 0 | microsoft | microsoft limited public licen[cs]e
ofl-1.1 | 0 | sil | sil open font licen[cs]e( version)?( 1 1)?
ofl | 1 | font | open font licen[cs]e
bitstream-vera | 0 | bitstream | bitstream vera
ubuntu-font | 0 | ubuntu | ubuntu font licen[cs]e
odbl-1.0 | 0 | database | open (data commons open )?database licen[cs]e( version)?( 1 0)?
odc-by-1.0 | 0 | commons | open data commons attribution licen[cs]e( version)?( 1 0)?
pddl-1.0 | 0 | dedication | (open data commons )?public domain dedication and licen[cs]e
ogl-3.0 | 0 | government | open government licen[cs]e( version)?( 3 0)?
etalab-2.0 | 0 | etalab* | etalab( open licen[cs]e)?( version)?( 2 0)?
cecill-2.1 | 0 | cecill* | cecill( version)? 2 1
cecill-b | 0 | cecill | cecill b
cecill-c | 0 | cecill | cecill c
cecill | 1 | cecill | cecill
eupl-1.2 | 0 | european | european union public licen[cs]e( version| v)? 1 2
eupl-1.1 | 0 | european | european union public licen[cs]e( version| v)? 1 1
eupl | 1 | european | european union public licen[cs]e
osl-3.0 | 0 | open | open software licen[cs]e( version| v)? 3 0
osl | 1 | open | open software licen[cs]e
afl-3.0 | 0 | academic | academic free licen[cs]e( version| v)? 3 0
afl-2.1 | 0 | academic | academic free licen[cs]e( version| v)? 2 1
afl | 1 | academic | academic free licen[cs]e
ecl-2.0 | 0 | educational | educational community licen[cs]e( version)?( 2 0)?
apsl-2.0 | 0 | apple | apple public source licen[cs]e( version)?( 2 0)?
ibm-pl | 0 | ibm | ibm public licen[cs]e( version)?( 1 0)?
cpl-1.0 | 0 | common | common public licen[cs]e( version| v)?( 1 0)?
cpal-1.0 | 0 | common | common public attribution licen[cs]e( version)?( 1 0)?
cddl-1.1 | 0 | common | common development and distribution licen[cs]e( version)? 1 1
cddl-1.0 | 0 | common | common development and distribution licen[cs]e( version)?( 1 0)?
cddl | 1 | cddl | cddl
epl-2.0 | 0 | eclipse | eclipse public licen[cs]e( version| v)? 2( 0)?
epl-1.0 | 0 | eclipse | eclipse public licen[cs]e( version| v)? 1( 0)?
epl | 1 | eclipse | eclipse public licen[cs]e
edl-1.0 | 0 | eclipse | eclipse distribution licen[cs]e( version)?( 1 0)?
mpl-2.0 | 0 | mozilla | mozilla public licen[cs]e( version| v)? 2( 0)?
mpl-1.1 | 0 | mozilla | mozilla public licen[cs]e( version| v)? 1 1
mpl-1.0 | 0 | mozilla | mozilla public licen[cs]e( version| v)? 1 0
mpl | 1 | mozilla | mozilla public licen[cs]e
npl-1.1 | 0 | netscape | netscape public licen[cs]e( version)?( 1 1)?
qpl-1.0 | 0 | q | q public licen[cs]e( version)?( 1 0)?
sspl-1.0 | 0 | server | server side public licen[cs]e( version| v)?( 1)?
busl-1.1 | 0 | business | business source licen[cs]e( version)?( 1 1)?
elastic-2.0 | 0 | elastic | elastic licen[cs]e( version)?( 2 0)?
confluent | 0 | confluent | confluent community licen[cs]e
commons-clause | 0 | clause | commons clause
polyform | 0 | polyform | polyform (noncommercial|shield|small business|strict|perimeter)( licen[cs]e)?
bigscience-rail | 0 | rail | (bigscience |open )?rail( m)?( licen[cs]e)
llama-community | 0 | llama | llama( 2| 3| 3 1)? community licen[cs]e
gemma | 0 | gemma | gemma terms of use
upl-1.0 | 0 | universal | universal permissive licen[cs]e( version| v)?( 1 0)?
json | 0 | evil | shall be used for good not evil
w3c | 0 | w3c | w3c (software|document)( notice and)?( licen[cs]e)?
unicode | 0 | unicode | unicode (data files and software )?licen[cs]e
icu | 0 | icu | icu licen[cs]e
zpl-2.1 | 0 | zope | zope public licen[cs]e( version)?( 2 1)?
lppl-1.3c | 0 | latex | latex project public licen[cs]e( version| v)?( 1 3c?)?
nasa-1.3 | 0 | nasa | nasa open source agreement( version)?( 1 3)?
rpl-1.5 | 0 | reciprocal | reciprocal public licen[cs]e( version)?( 1 5)?
sun-sissl | 0 | sun | sun industry standards source licen[cs]e
watcom-1.0 | 0 | watcom | (sybase )?open watcom public licen[cs]e
mulan-psl-2.0 | 0 | mulan | mulan (permissive|psl)( software)?( licen[cs]e)?( version)?( 2)?
hpnd | 0 | historical | historical permission notice and disclaimer
ntp | 0 | ntp | ntp licen[cs]e
public-domain | 0 | domain | (released|placed|dedicated) (in|into|to) the public domain
public-domain | 1 | domain | public domain
free-art-1.3 | 0 | art | free art licen[cs]e( version)?( 1 3)?
oracle-bcl | 0 | oracle | oracle binary code licen[cs]e
proprietary | 0 | proprietary | proprietary and confidential
proprietary | 1 | proprietary | proprietary (licen[cs]e|software|information)
commercial | 1 | commercial | commercial licen[cs]e
noncommercial | 1 | commercial/noncommercial | (for |only for )?non ?commercial use only
no-redistribution | 1 | redistribute | (may|must) not redistribute
no-warranty | 2 | warranty | without warranty of any kind
no-warranty | 2 | warranty | without any warranty
as-is | 2 | provided | (is )?provided as is
spdx | 1 | spdx | spdx license identifier [^ ]+
license-reference | 2 | licensed | licensed under( the)?
license-reference | 2 | license | (see|read) the license( file)?
license-reference | 2 | license | terms of (the|this) license
license-reference | 2 | permission | used (by|with) permission
copyright | 2 | copyright | copyright( c)?( [0-9]{4})?( [0-9]{4})?
"""

GNU = (("agpl", "affero", "(gnu )?affero general public licen[cs]e"),
       ("lgpl", "lesser", "(gnu )?lesser general public licen[cs]e"),
       ("lgpl", "library", "(gnu )?library general public licen[cs]e"),
       ("gfdl", "documentation", "(gnu )?free documentation licen[cs]e"),
       ("gpl", "general", "(gnu )?general public licen[cs]e"),
       ("agpl", "agpl*", "agpl"), ("lgpl", "lgpl*", "lgpl"), ("gpl", "gpl*", "gpl"))
GNU_VERSIONS = ("1", "1 1", "1 2", "1 3", "2", "2 1", "3")
CC = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(ative)?s",
            "nc": "non ?commercial"}


# What may stand between a name and its version: a space, " v", " version ", a joined v.
BETWEEN = r"(?: version| ver)?(?: ?v ?| ?)"


def versioned(regex: str) -> str:
    """The regex with all ways to write a version where it says ``( version)?``."""
    regex = re.sub(r"\( version(?:\| v)?\)\?\( (?=\d)", lambda _: f"({BETWEEN}", regex)
    return re.sub(r"\( version(?:\| v)?\)\? (?=\d)", lambda _: BETWEEN, regex)


OPTIONAL = re.compile(r"(.*?)(?:\( version(?:\| v)?\)\?)?\(( \d[^()]*)\)\?")


def told(row: tuple) -> list[tuple]:
    """A listed rule whose version may be missing, as two: with the version in the text, its
    label; with the name alone, or with another version, the label without one."""
    label, tier, keyword, regex, base = row
    found, bare = OPTIONAL.fullmatch(regex), re.sub(r"-\d.*", "", label)
    if not found or bare == label or found[1][-1].isdigit():  # there, only a ".0" may be missing
        return [row]
    name, number = found.groups()
    return [(label, tier, keyword, f"{name}( version)?{number}", base),
            (bare, "1", keyword, name, base)]


def identifier(row: tuple) -> list[tuple]:
    """A listed license as an SPDX identifier."""
    label, tier, *_ = row
    if tier != "0":
        return []
    words = re.sub(r"[-.]", " ", label)
    return [(label, "0", "spdx", f"spdx license identifier {words}", False)]


def terms(keyword: str) -> list[str]:
    """What a rule's keywords look like in a normalised text."""
    return [f" {w[:-1]}" if w.endswith("*") else f" {w} " for w in keyword.split("/")]


def signatures() -> list[dict]:
    """All rules in priority order: the listed ones, the families with their versions, and
    the base phrases."""
    def read(text: str, base: bool) -> list[tuple]:
        return [(*(x.strip() for x in line.split("|", 3)), base)
                for line in text.strip().splitlines()]

    listed = read(SIGNATURES, False)
    rows = [r for row in listed for r in told(row)]
    rows += {r[0]: r for row in listed for r in identifier(row)}.values()
    for label, keyword, name in GNU:
        for v in GNU_VERSIONS:
            number = v.replace(" ", ".")
            zero = "" if " " in v else "( 0)?"
            head = f"{name}( version)? {v}{zero}"
            rows.append((f"{label}-{number}-or-later", "0", keyword,
                         f"{head}( of the licen[cs]e)? or (at your option )?(any )?later"
                         "( version)?",
                         False))
            rows.append((f"{label}-{number}", "0", keyword, f"{head}( only)?", False))
        if label != "gpl" or keyword != "general":
            rows.append((label, "1", keyword, name, False))
    for kind in CC:
        words = " ".join(CC_WORDS[k] for k in kind.split())
        name = kind.replace(" ", "-")
        for v in CC_VERSIONS:
            rows.append((f"cc-{name}-{v.replace(' ', '.')}", "0", "cc", f"cc {kind}( version)? {v}", False))
            rows.append((f"cc-{name}-{v.replace(' ', '.')}", "0", "commons",
                         f"creative commons {words}( licen[cs]e)?( version)? {v}",
                         False))
        if kind != "by":
            rows.append((f"cc-{name}", "1", "cc", f"cc {kind}", False))
        rows.append((f"cc-{name}", "1", "commons", f"creative commons {words}", False))
    rows += [("cc0-1.0", "0", "cc0", "cc0( 1 0)?( universal)?", False),
             ("creative-commons", "2", "commons", "creative commons", False)]
    return [{"label": label, "tier": int(tier), "keyword": keyword, "base": base, "rank": i,
             "regex": f"(?<= )(?:{versioned(regex)})(?= )"}
            for i, (label, tier, keyword, regex, base) in enumerate(rows + read(BASE, True))]


RULES = signatures()


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def normalised(text: str = "text") -> Column:
    """`` w1 w2 ... wn `` with a space at either end; one space if there is no word. Only
    A-Z change case: two letters whose lower case is or holds an ASCII one are set aside."""
    kept = F.replace(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("İ"),
                               F.lit("ı")), F.lit("K"), F.lit("ĸ"))
    words = F.trim(F.regexp_replace(F.lower(kept), APART, " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _rule_array(rules: list[dict]) -> Column:
    return F.array(*[F.struct(
        F.lit(r["keyword"]).alias("keyword"), F.lit(r["regex"]).alias("regex"),
        F.lit(r["label"]).alias("label"), F.lit(r["tier"]).alias("tier"),
        F.lit(r["rank"]).alias("rank"), F.lit(r["base"]).alias("base")) for r in rules])


def detections(rules: list[dict]) -> Column:
    """All detections of the row's ``norm``: first word, minus the word after the last,
    tier, rank, label, base, in sort order."""
    words = sorted({r["keyword"] for r in rules})
    keyed = F.array(*[F.struct(F.lit(w).alias("key"), F.array(*[F.lit(t) for t in terms(w)])
                               .alias("terms")) for w in words])
    hits = F.transform(F.filter(keyed, lambda k: F.exists(
        k["terms"], lambda t: F.contains(F.col("norm"), t))), lambda k: k["key"])
    live = F.filter(_rule_array(rules), lambda r: F.array_contains(F.col("hits"), r["keyword"])
                    & F.rlike(F.col("norm"), r["regex"]))

    def places(r: Column) -> Column:
        marked = F.split(F.regexp_replace(F.col("norm"), r["regex"], F.lit("\x01$0")), " ")
        starts = F.filter(F.transform(marked, lambda w, i: F.when(
            F.startswith(w, F.lit("\x01")), i - 1)), lambda i: i.isNotNull())
        texts = F.regexp_extract_all(F.col("norm"), r["regex"], F.lit(0))
        return F.transform(F.arrays_zip(starts.alias("at"), texts.alias("text")), lambda m:
                           F.struct(m["at"].alias("start"),
                                    (-(m["at"] + _spaces(m["text"]) + 1)).alias("end"),
                                    r["tier"].alias("tier"), r["rank"].alias("rank"),
                                    r["label"].alias("label"), r["base"].alias("base")))

    return hits, F.array_sort(F.flatten(F.transform(live, places)))


def scan(docs: DataFrame, rules: list[dict] | None = None) -> DataFrame:
    """One row per input row: doc_id, words, base places, labels, score.

    ``score`` is 1, 0.7 or 0.4 for the strongest tier that is left, 0 for none. A null or
    empty text has no word and no label. Repeated rows and null ids are kept. Only doc_id
    and text are read.
    """
    hits, found = detections(rules or RULES)
    low = F.lit(-1)

    def add(acc: Column, d: Column) -> Column:
        end, tier = -d["end"], d["tier"]
        over = [acc["m0"], acc["m1"], acc["m2"]]
        same = F.when(tier == 0, over[0]).when(tier == 1, over[1]).otherwise(over[2])
        stronger = F.when(tier == 0, low).when(tier == 1, over[0]).otherwise(over[1])
        keep = (same < end) & (stronger <= d["start"])
        return F.struct(
            *[F.when(tier <= t, F.greatest(m, end)).otherwise(m).alias(f"m{t}")
              for t, m in enumerate(over)],
            F.when(keep, F.least(acc["best"], tier)).otherwise(acc["best"]).alias("best"),
            F.when(keep, F.array_union(acc["labels"], F.array(d["label"])))
            .otherwise(acc["labels"]).alias("labels"))

    start = F.struct(low.alias("m0"), low.alias("m1"), low.alias("m2"), F.lit(3).alias("best"),
                     F.array().cast("array<string>").alias("labels"))
    rows = (docs.select("doc_id", normalised().alias("norm")).withColumn("hits", hits)
            .withColumn("found", F.when(F.size("hits") > 0, found))
            .select("doc_id", (_spaces(F.col("norm")) - 1).cast("long").alias("n_words"),
                    "found", F.filter("found", lambda d: d["base"]).alias("base"),
                    F.aggregate("found", start, add).alias("kept")))
    base_labels = F.coalesce(F.array_sort(F.array_distinct(F.transform(
        "base", lambda d: d["label"]))), F.array().cast("array<string>"))
    labels = F.array_sort(F.array_union(base_labels, F.coalesce(
        "kept.labels", F.array().cast("array<string>"))))
    scores = F.element_at(F.array(*[F.lit(x) for x in (1.0, 0.7, 0.4, 0.0)]),
                          F.coalesce("kept.best", F.lit(3)) + 1)
    at = F.transform("base", lambda d: d["start"].cast("long"))
    return rows.select(
        "doc_id", "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), scores.alias("score"))


def op3_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return scan(table(spark, sf_dir, "documents"))
