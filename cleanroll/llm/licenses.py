"""License scans with DataFrame functions only: ordered signature rules, a keyword gate, suppression by containment."""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

# The base phrases and their labels, and what stands between words once A-Z are lower case.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Priorities: a full name with its version, a name, a family, a mere notice.
EXACT, NAMED, FAMILY, NOTICE = 1, 2, 3, 4
SCORES = {EXACT: 1.0, NAMED: 0.9, FAMILY: 0.6, NOTICE: 0.3}


def _rules() -> list[tuple[str, str, str, int]]:
    """(keyword, pattern, label, priority) in order. Patterns are over words with one space between them; ` N ` below is a version."""
    out: list[tuple[str, str, str, int]] = []
    version = lambda v: v.replace(".", " ")  # noqa: E731  words of "4.0" are "4" and "0"
    # Creative Commons: six terms, each short and in words, with and without a version.
    long_of = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:atives|ative works|s)?"}
    for terms in ("by-nc-sa", "by-nc-nd", "by-nc", "by-nd", "by-sa", "by"):
        short, full = terms.replace("-", " "), " ".join(long_of[t] for t in terms.split("-"))
        for v in ("4.0", "3.0", "2.5", "2.0", "1.0"):
            out.append((" cc by", f"cc {short} {version(v)}", f"cc-{terms}-{v}", EXACT))
            out.append(("attribution", f"{full}(?: license)? {version(v)}(?: (?:international|unported|generic))?", f"cc-{terms}-{v}", EXACT))
            out.append(("creativecommons", f"creativecommons org licenses {short} {version(v)}", f"cc-{terms}-{v}", EXACT))
        out.append((" cc by", f"cc {short}", f"cc-{terms}", NAMED))
        out.append(("creative commons", f"creative commons {full}", f"cc-{terms}", NAMED))
    # The GNU licenses: names by version, this one only or any later.
    gnu = {"gpl": "(?:gnu )?general public license", "lgpl": "(?:gnu )?(?:lesser|library) general public license", "agpl": "(?:gnu )?affero general public license", "gfdl": "(?:gnu )?free documentation license"}
    versions = {"gpl": ("3.0", "2.0", "1.0"), "lgpl": ("3.0", "2.1", "2.0"), "agpl": ("3.0", "1.0"), "gfdl": ("1.3", "1.2", "1.1")}
    for name, full in gnu.items():
        for v in versions[name]:
            number = version(v).removesuffix(" 0") + "(?: 0)?" if v.endswith(".0") else version(v)
            later = "(?:or (?:at your option )?(?:any )?later(?: version)?|or newer|plus)"
            out.append((f" {name}", f"{name} ?v?(?:ersion )?{number} {later}", f"{name}-{v}-or-later", EXACT))
            out.append((f" {name}", f"{name} ?v?(?:ersion )?{number}(?: only)?", f"{name}-{v}", NAMED))
            out.append((full.rsplit(" ", 2)[-2] + " license" if name != "gfdl" else "documentation license", f"{full}(?: as published by the free software foundation)? (?:either )?v(?:ersion )?{number} {later}", f"{name}-{v}-or-later", EXACT))
            out.append(("public license" if name != "gfdl" else "documentation license", f"{full} v(?:ersion )?{number}", f"{name}-{v}", NAMED))
        out.append(("public license" if name != "gfdl" else "documentation license", full, name, FAMILY))
        out.append((f" {name}", f"(?:gnu {name}|{name} licen[cs]ed?|under the {name})", name, FAMILY))
    # Licenses known by name, with or without a version.
    named = {
        "apache": ("1.0", "1.1", "2.0"), "mozilla public": ("1.0", "1.1", "2.0"), "eclipse public": ("1.0", "2.0"), "common development and distribution": ("1.0", "1.1"),
        "artistic": ("1.0", "2.0"), "boost software": ("1.0",), "academic free": ("1.1", "2.1", "3.0"), "open software": ("1.0", "2.0", "3.0"), "educational community": ("1.0", "2.0"),
        "european union public": ("1.0", "1.1", "1.2"), "microsoft public": (), "microsoft reciprocal": (), "sil open font": ("1.0", "1.1"), "open data commons open database": ("1.0",),
        "open data commons attribution": ("1.0",), "zope public": ("1.1", "2.0", "2.1"), "python software foundation": ("2.0",), "php": ("3.0", "3.01"), "ruby": (), "isc": (), "mit": (),
        "zlib": (), "x11": (), "ntp": (), "unlicense": (), "postgresql": (), "openssl": (), "curl": (), "wtfpl": ("2.0",), "beerware": (), "common public": ("1.0",), "ibm public": ("1.0",),
        "lucent public": ("1.0", "1.02"), "q public": ("1.0",), "sleepycat": (), "vim": (), "w3c software": (), "cecill": ("1.0", "2.0", "2.1"), "eiffel forum": ("1.0", "2.0"),
        "universal permissive": ("1.0",), "bsd zero clause": (), "bsd 2 clause": (), "bsd 3 clause": (), "bsd 4 clause": (), "simplified bsd": (), "new bsd": (), "bsd": (),
        "free art": ("1.3",), "open government": ("1.0", "2.0", "3.0"), "server side public": ("1.0",), "business source": ("1.1",), "elastic": ("2.0",), "blue oak model": ("1.0",), "mulan permissive software": ("1.0", "2.0"),
    }
    for name, known in named.items():
        label = name.replace(" ", "-")
        for v in known:
            out.append((name, f"{name}(?: software)? licen[cs]e (?:v|version )?{version(v).removesuffix(' 0')}(?: 0)?" if v.endswith(".0") else f"{name}(?: software)? licen[cs]e (?:v|version )?{version(v)}", f"{label}-{v}", EXACT))
        out.append((name, f"{name}(?: software)? licen[cs]e", label, NAMED))
        out.append((name, f"licen[cs]ed under (?:the )?(?:terms of the )?{name}", label, NAMED))
    # Opening words of license texts, and notices.
    out += [
        ("permission is hereby", "permission is hereby granted free of charge to any person obtaining a copy", "mit", EXACT),
        ("permission is hereby", "permission is hereby granted", "permissive", FAMILY),
        ("permission to use", "permission to use copy modify and(?: or)? distribute this software for any purpose", "isc", EXACT),
        ("redistribution and use", "redistribution and use in source and binary forms", "bsd", NAMED),
        ("without warranty", "without warranty of any kind", "no-warranty", NOTICE),
        ("public domain", "(?:dedicated to|released (?:in)?to|in) the public domain", "public-domain", NAMED),
        ("public domain", "public domain", "public-domain", FAMILY),
        (" cc0 ", "cc0(?: 1 0)?", "cc0", EXACT),
        ("creative commons", "creative commons zero", "cc0", EXACT),
        ("creative commons", "creative commons", "cc", FAMILY),
        ("spdx", "spdx license identifier [0-9a-z]+(?: [0-9]+)*", "spdx", FAMILY),
        ("copyright", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", "copyright", NOTICE),
        ("licen", "licen[cs]ed under(?: the| an?)?(?: terms of(?: the)?)?", "license-notice", NOTICE),
        ("licen", "(?:released|distributed|available) under(?: [^ ]+){1,5} licen[cs]e", "license-notice", NOTICE),
        ("terms of", "(?:released|distributed|available) under(?: the)? terms of(?: the)?", "license-notice", NOTICE),
        ("licen", "see (?:the )?licen[cs]e(?: file)?(?: for (?:more )?(?:details|information))?", "license-notice", NOTICE),
        ("rights reserved", "(?:some|no) rights reserved", "rights-notice", NOTICE),
    ]
    out = [(k, p.removesuffix(" "), label, n) for k, p, label, n in out]
    for verb, object_ in product(("may not", "must not", "cannot"), ("copy", "redistribute", "reproduce", "resell", "modify", "sublicense")):
        out.append((verb, f"you {verb} {object_}", "restricted", NOTICE))
    return out


RULES = _rules()
CHOICE = re.compile(r"\(\?:[^()]*\)\??")


def gate_words(rules) -> list[str]:
    """Texts of which one is in every text that a rule can match: "licen" where a match always holds it, else the rule's keyword."""
    words = set()
    for keyword, pattern, _, _ in rules:
        sure = pattern
        while CHOICE.search(sure):  # what may be absent or stands beside another choice
            sure = CHOICE.sub("#", sure)
        words.add("licen" if re.search(r"licen(?!\?)", sure) else keyword)
    return sorted(words)


GATE = tuple(gate_words(RULES))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _rule_array(rules) -> Column:
    """The rules as one constant array of structs, in their order."""
    each = [
        F.struct(F.lit(keyword).alias("keyword"), F.lit(f" {pattern}(?= )").alias("pattern"), F.lit(label).alias("label"), F.lit(n).alias("priority"), F.lit(k).alias("place"))
        for k, (keyword, pattern, label, n) in enumerate(rules)
    ]
    return F.array(*each)


def _found(norm: Column, rule: Column) -> Column:
    """(start, end, label, priority, place) of each match of a rule, in words.

    What lies between the matches and the matches themselves take turns; a space stands before each word, so a sum of
    spaces is a place.
    """
    between = F.call_function("split", norm, rule["pattern"], F.lit(-1))
    matches = F.call_function("regexp_extract_all", norm, rule["pattern"], F.lit(0))
    pairs = F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("hit"))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    walk = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda state, x: F.struct(
            (state["at"] + _spaces(x["gap"]) + _spaces(x["hit"])).alias("at"),
            F.concat(state["spans"], F.array(F.struct((state["at"] + _spaces(x["gap"])).alias("start"), (state["at"] + _spaces(x["gap"]) + _spaces(x["hit"])).alias("end")))).alias("spans"),
        ),
    )["spans"]
    return F.transform(walk, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), rule["label"].alias("label"), rule["priority"].alias("priority"), rule["place"].alias("place")))


def _kept(found: Column) -> Column:
    """Without the detections that lie within one of an earlier priority, or of the same one but an earlier rule or more words."""
    def beats(e: Column, d: Column) -> Column:
        wider = (e["end"] - e["start"]) > (d["end"] - d["start"])
        same = e["priority"] == d["priority"]
        return (e["start"] <= d["start"]) & (e["end"] >= d["end"]) & ((e["priority"] < d["priority"]) | same & (wider | (e["place"] < d["place"])))

    return F.filter(found, lambda d: ~F.exists(found, lambda e: beats(e, d)))


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """`docs` plus `n_words, n_base, first_word, last_word, base_labels, labels, score, detections` for the whole text.

    Base places are of the base phrases; their labels stay whatever the rules say. `detections` are the rules' matches left
    after suppression, as (start, end, label, priority, place) in words. score is the best of the detections' and 0.5 for a
    base label. A null or empty text has no words, no places, empty labels and score 0. Each row is scanned by itself, so
    repeated rows and null ids need no care; columns of `docs` that clash with a result's name are replaced.
    """
    results = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections", "_norm"]
    docs = docs.drop(*(set(results) & set(docs.columns)))
    words = F.trim(F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), GAP, " "))
    norm = F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))
    rows = docs.withColumn("_norm", norm).withColumn("n_words", F.greatest(_spaces(F.col("_norm")) - 1, F.lit(0)).cast("long"))
    text = F.col("_norm")
    places = []
    for phrase, label in BASE.items():
        n = phrase.count(" ") + 1
        parts = F.split(text, f" {phrase}(?= )", -1)
        first = _spaces(parts[0]).cast("long")
        last = F.col("n_words") - (_spaces(F.element_at(parts, -1)) - 1) - n
        some = F.struct((F.size(parts) - 1).cast("long").alias("n"), first.alias("first"), last.alias("last"), F.lit(label).alias("label"))
        places.append(F.when(F.contains(text, F.lit(f" {phrase} ")), some))
    rows = rows.withColumn("_base", F.array_compact(F.array(*places)))
    gate = F.lit(False)
    for word in GATE if rules is RULES else gate_words(rules):
        gate = gate | F.contains(text, F.lit(word))
    likely = F.filter(_rule_array(rules), lambda r: F.contains(text, r["keyword"]))
    all_found = F.flatten(F.transform(likely, lambda r: _found(text, r)))
    empty = "cast(array() as array<struct<start:int,end:int,label:string,priority:int,place:int>>)"
    rows = rows.withColumn("detections", F.when(gate, all_found).otherwise(F.expr(empty)))
    rows = rows.withColumn("detections", F.when(F.size("detections") > 1, _kept(F.col("detections"))).otherwise(F.col("detections")))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    of = lambda name: F.transform("_base", lambda b: b[name])
    by_rule = F.transform("detections", lambda d: F.element_at(F.array(*[F.lit(SCORES[p]) for p in sorted(SCORES)]), d["priority"]))
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns], "n_words", F.aggregate(of("n"), F.lit(0).cast("long"), lambda a, x: a + x).alias("n_base"),
        F.array_min(of("first")).alias("first_word"), F.array_max(of("last")).alias("last_word"), joined(of("label")).alias("base_labels"),
        joined(F.concat(of("label"), F.transform("detections", lambda d: d["label"]))).alias("labels"),
        F.greatest(F.coalesce(F.array_max(by_rule), F.lit(0.0)), F.when(F.size("_base") > 0, 0.5).otherwise(0.0)).alias("score"), "detections",
    )
