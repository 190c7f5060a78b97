"""License scans by ordered signature rules.

A text becomes its words, lower-cased and joined by single spaces. Every rule is a regular expression over these words
with a keyword that any match of it contains; one pass per text collects the keywords that occur, and only their rules
are tried. Matches are word intervals. Rules are ordered by priority (full grants before titles before short names
before hints); an interval that lies inside one of equal or better priority is suppressed. What remains labels the text.

Everything happens inside the row: no shuffle, no join, and repeated rows stay repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, text_of

# The base phrases and their labels, and the characters that separate words.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

GRANT, TITLE, SHORT, HINT = 1, 2, 3, 4
CONFIDENCE = {GRANT: 1.0, TITLE: 0.9, SHORT: 0.7, HINT: 0.4}
BASE_CONFIDENCE = 0.5


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str  # one word that every match contains
    pattern: str  # over words joined by single spaces


# Words between "licensed" and a title, and how versions are written once punctuation is gone.
_GRANT = r"(?:licensed|released|distributed|available|provided|published|made available|redistributed) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"
_VER = r"(?:v|version|ver)? ?"
_NUM = {"1": r"1(?: 0)?", "1.0": r"1 0", "1.1": r"1 1", "1.2": r"1 2", "1.3": r"1 3", "1.4": r"1 4", "2": r"2(?: 0)?", "2.0": r"2(?: 0)?",
        "2.1": r"2 1", "2.2": r"2 2", "2.3": r"2 3", "2.5": r"2 5", "3": r"3(?: 0)?", "3.0": r"3(?: 0)?", "3.5": r"3 5", "3.6": r"3 6", "4.0": r"4(?: 0)?"}

# (label, title, short names, keyword of the title, versions); a number after php or openssl is the version of the software
_FAMILIES = (
    ("apache", r"apache (?:software )?licen[sc]e", r"apache|asl", "apache", ("1.0", "1.1", "2.0")),
    ("gpl", r"(?:gnu )?general public licen[sc]e", r"gnu gpl|gpl|gplv", "public", ("1", "2", "3")),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", r"gnu lgpl|lgpl|lgplv", "public", ("2", "2.1", "3")),
    ("agpl", r"(?:gnu )?affero general public licen[sc]e", r"gnu agpl|agpl|agplv", "affero", ("1", "3")),
    ("gfdl", r"(?:gnu )?free documentation licen[sc]e", r"gnu fdl|gfdl", "documentation", ("1.1", "1.2", "1.3")),
    ("mpl", r"mozilla public licen[sc]e", r"mpl", "mozilla", ("1.0", "1.1", "2.0")),
    ("epl", r"eclipse public licen[sc]e", r"epl", "eclipse", ("1.0", "2.0")),
    ("edl", r"eclipse distribution licen[sc]e", r"edl", "eclipse", ("1.0",)),
    ("cddl", r"common development and distribution licen[sc]e", r"cddl", "distribution", ("1.0", "1.1")),
    ("cpl", r"common public licen[sc]e", r"cpl", "common", ("1.0",)),
    ("cpal", r"common public attribution licen[sc]e", r"cpal", "attribution", ("1.0",)),
    ("eupl", r"european union public licen[sc]e", r"eupl", "european", ("1.0", "1.1", "1.2")),
    ("ecl", r"educational community licen[sc]e", r"ecl", "educational", ("1.0", "2.0")),
    ("osl", r"open software licen[sc]e", r"osl", "software", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", r"academic free licen[sc]e", r"afl", "academic", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("artistic", r"(?:clarified )?artistic licen[sc]e", r"artistic", "artistic", ("1.0", "2.0")),
    ("boost", r"boost software licen[sc]e", r"bsl", "boost", ("1.0",)),
    ("busl", r"business source licen[sc]e", r"busl", "business", ("1.0", "1.1")),
    ("sspl", r"server side public licen[sc]e", r"sspl", "server", ("1",)),
    ("lppl", r"latex project public licen[sc]e", r"lppl", "latex", ("1.0", "1.1", "1.2", "1.3")),
    ("ofl", r"(?:sil )?open font licen[sc]e", r"ofl", "font", ("1.0", "1.1")),
    ("odbl", r"open (?:data commons open )?database licen[sc]e", r"odbl", "database", ("1.0",)),
    ("odc-by", r"open data commons attribution licen[sc]e", r"odc by", "commons", ("1.0",)),
    ("python", r"python (?:software foundation )?licen[sc]e", r"psf", "python", ("2.0",)),
    ("php", r"php licen[sc]e", "", "php", ("3.0",)),
    ("zpl", r"zope public licen[sc]e", r"zpl", "zope", ("1.1", "2.0", "2.1")),
    ("qpl", r"q public licen[sc]e", r"qpl", "q", ("1.0",)),
    ("npl", r"netscape public licen[sc]e", r"npl", "netscape", ("1.0", "1.1")),
    ("apsl", r"apple public source licen[sc]e", r"apsl", "apple", ("1.0", "1.1", "1.2", "2.0")),
    ("rpl", r"reciprocal public licen[sc]e", r"rpl", "reciprocal", ("1.1",)),
    ("upl", r"universal permissive licen[sc]e", r"upl", "universal", ("1.0",)),
    ("mulan", r"mulan (?:psl|permissive software licen[sc]e)", r"mulanpsl", "mulan", ("1", "2")),
    ("cecill", r"cecill(?: free software)? licen[sc]e(?: agreement)?", r"cecill", "cecill", ("1.0", "1.1", "2.0", "2.1")),
    ("openssl", r"openssl licen[sc]e", "", "openssl", ("1.0",)),
    ("polyform", r"polyform (?:noncommercial|small business|shield) licen[sc]e", r"polyform", "polyform", ("1.0",)),
    ("elastic", r"elastic licen[sc]e", r"elv", "elastic", ("1.0", "2.0")),
    ("openrail", r"(?:open )?rail(?: m)? licen[sc]e", r"openrail|rail m", "rail", ("1.0",)),
    ("llama", r"llama(?: [23])? community licen[sc]e", r"llama licen[sc]e", "llama", ("2", "3")),
    ("unlicense", r"the unlicense|unlicense", r"unlicense", "unlicense", ()),
)

# Texts and titles without versions of their own.
_SINGLE = (
    ("mit", GRANT, "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", GRANT, "mit", _GRANT + r"mit licen[sc]e"),
    ("mit", TITLE, "license", r"(?:the )?mit license"), ("mit", TITLE, "licence", r"(?:the )?mit licence"),
    ("mit", SHORT, "expat", r"expat licen[sc]e"), ("mit-0", TITLE, "mit", r"mit no attribution(?: licen[sc]e)?"),
    ("isc", GRANT, "isc", _GRANT + r"isc licen[sc]e"), ("isc", TITLE, "isc", r"isc licen[sc]e"),
    ("isc", GRANT, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", GRANT, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", GRANT, "endorse", r"may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", GRANT, "advertising", r"all advertising materials mentioning features or use of this software"),
    ("bsd", SHORT, "bsd", r"bsd(?: style)? licen[sc]e"), ("bsd", GRANT, "bsd", _GRANT + r"(?:\S+ ){0,3}bsd licen[sc]e"),
    ("bsd-0-clause", TITLE, "bsd", r"(?:0 clause bsd|zero clause bsd|bsd 0 clause)(?: licen[sc]e)?"),
    ("bsd-0-clause", TITLE, "0bsd", r"0bsd(?: licen[sc]e)?"), ("bsd-2-clause", TITLE, "freebsd", r"freebsd(?: licen[sc]e)?"),
    ("bsd-2-clause", TITLE, "bsd", r"(?:2 clause bsd|simplified bsd|bsd 2 clause)(?: licen[sc]e)?"),
    ("bsd-3-clause", TITLE, "bsd", r"(?:3 clause bsd|new bsd|revised bsd|modified bsd|bsd 3 clause)(?: licen[sc]e)?"),
    ("bsd-4-clause", TITLE, "bsd", r"(?:4 clause bsd|original bsd|bsd 4 clause)(?: licen[sc]e)?"),
    ("zlib", TITLE, "zlib", r"zlib(?: libpng)? licen[sc]e"), ("zlib", GRANT, "warranty", r"this software is provided as is without any express or implied warranty in no event will the authors"),
    ("wtfpl", TITLE, "wtfpl", r"wtfpl"), ("wtfpl", GRANT, "fuck", r"do what the fuck you want to public licen[sc]e"),
    ("apache-2.0", GRANT, "compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", GRANT, "perpetual", r"perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("gpl", GRANT, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", GRANT, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", GRANT, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", GRANT, "warranty", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu"),
    ("public-domain", TITLE, "domain", r"(?:dedicated to|released (?:in)?to|placed in(?:to)?|in) the public domain"),
    ("public-domain", SHORT, "domain", r"public domain"), ("pddl", TITLE, "pddl", r"pddl(?: 1 0)?"),
    ("pddl", TITLE, "dedication", r"public domain dedication and licen[sc]e"),
    ("cc0-1.0", TITLE, "cc0", r"cc0(?: 1 0)?(?: universal)?"), ("cc0-1.0", TITLE, "zero", r"(?:creative commons|cc) zero"),
    ("cc0-1.0", GRANT, "waived", r"to the extent possible under law .{1,60}? has waived all copyright"),
    ("cc", SHORT, "creative", r"creative commons(?: licen[sc]e)?"),
    ("proprietary", TITLE, "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", TITLE, "unauthorized", r"unauthorized (?:copying|use|reproduction|distribution) .{0,60}?is (?:strictly )?prohibited"),
    ("proprietary", SHORT, "proprietary", r"proprietary licen[sc]e"), ("proprietary", HINT, "trade", r"trade secrets?"),
    ("proprietary", TITLE, "reproduced", r"no part of this (?:\S+ ){1,3}may be reproduced"),
    ("reserved", TITLE, "reserved", r"(?:all|some|no) rights(?: are)? reserved"),
    ("copyright", HINT, "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"), ("copyright", HINT, "copyrighted", r"copyrighted (?:work|material)"),
    ("commercial", TITLE, "commercial", r"commercial licen[sc]e(?: agreement)?"), ("eula", TITLE, "agreement", r"end user licen[sc]e agreement"),
    ("eula", SHORT, "eula", r"eula"), ("non-commercial", HINT, "non", r"non commercial (?:use|purposes?)(?: only)?"),
    ("non-commercial", HINT, "noncommercial", r"noncommercial (?:use|purposes?)(?: only)?"),
    ("academic", HINT, "research", r"(?:for )?(?:academic|non profit) research (?:use|purposes?) only"),
    ("beerware", TITLE, "beer", r"beer ware licen[sc]e"), ("json", GRANT, "evil", r"the software shall be used for good not evil"),
    ("ms-pl", TITLE, "microsoft", r"microsoft public licen[sc]e"), ("ms-rl", TITLE, "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("ncsa", TITLE, "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e"), ("postgresql", TITLE, "postgresql", r"postgresql licen[sc]e"),
    ("ruby", TITLE, "ruby", r"ruby licen[sc]e"), ("perl", HINT, "perl", r"under the same terms as perl(?: itself)?"),
    ("vim", TITLE, "vim", r"vim licen[sc]e"), ("w3c", TITLE, "w3c", r"w3c software(?: notice)?(?: and)? licen[sc]e"), ("x11", TITLE, "x11", r"x11 licen[sc]e"),
    ("curl", TITLE, "curl", r"curl licen[sc]e"), ("icu", TITLE, "icu", r"icu licen[sc]e"), ("ijg", TITLE, "jpeg", r"independent jpeg group licen[sc]e"),
    ("libpng", TITLE, "libpng", r"libpng licen[sc]e"), ("libtiff", TITLE, "libtiff", r"libtiff licen[sc]e"), ("unicode", TITLE, "unicode", r"unicode (?:data files and software )?licen[sc]e"),
    ("bittorrent", TITLE, "bittorrent", r"bittorrent open source licen[sc]e"), ("sleepycat", TITLE, "sleepycat", r"sleepycat licen[sc]e"),
    ("vovida", TITLE, "vovida", r"vovida software licen[sc]e"), ("watcom", TITLE, "watcom", r"sybase open watcom public licen[sc]e"),
    ("spdx", HINT, "spdx", r"spdx license identifier \S+"), ("licensed", HINT, "license", r"see (?:the )?license(?: file)?(?: for details)?"),
    ("licensed", HINT, "terms", r"(?:subject to|under) the terms of (?:the|this) licen[sc]e"),
)


def _creative_commons() -> list[Rule]:
    words = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
    rules = []
    for parts in (("by",), ("by", "sa"), ("by", "nd"), ("by", "nc"), ("by", "nc", "sa"), ("by", "nc", "nd")):
        kind, short, full = "-".join(parts), " ".join(parts), " ".join(words[p] for p in parts)
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            rules.append(Rule(f"cc-{kind}-{version}", TITLE, "cc", rf"cc {short} {_NUM[version]}"))
            rules.append(Rule(f"cc-{kind}-{version}", TITLE, "commons", rf"creative commons {full} {_NUM[version]}"))
        rules.append(Rule(f"cc-{kind}", SHORT, "cc", rf"cc {short}"))
        rules.append(Rule(f"cc-{kind}", SHORT, "commons", rf"creative commons {full}"))
    return rules


def _families() -> list[Rule]:
    rules = []
    for label, title, short, title_word, versions in _FAMILIES:
        names = [(name, next(w for w in name.split() if w != "gnu")) for name in short.split("|") if name]
        for version in versions:
            number = _NUM[version]
            rules.append(Rule(f"{label}-{version}", GRANT, title_word, rf"{_GRANT}{title} {_VER}{number}(?: or (?:any |at your option any )?later(?: version)?)?"))
            rules.append(Rule(f"{label}-{version}", TITLE, title_word, rf"{title} {_VER}{number}"))
            for name, word in names:
                rules.append(Rule(f"{label}-{version}", TITLE, word, rf"{name} {_VER}{number}"))
                if word.endswith("v"):
                    rules.append(Rule(f"{label}-{version}", TITLE, word + version[0], rf"{name}{number}"))
        rules.append(Rule(label, SHORT, title_word, title))
        for name, word in names:
            rules.append(Rule(label, HINT, word, name if "licen" in name else rf"{name} licen[sc]e"))
    for label, name, versions in (("gpl", "gpl", ("2", "3")), ("lgpl", "lgpl", ("2.1", "3")), ("agpl", "agpl", ("3",))):
        for version in versions:
            rules.append(Rule(f"{label}-{version}", TITLE, name, rf"(?:gnu )?{name} {_VER}{_NUM[version]}"))
            rules.append(Rule(f"{label}-{version}", TITLE, f"{name}v{version[0]}", rf"{name}v{_NUM[version]}"))
        rules.append(Rule(label, SHORT, name, rf"(?:gnu )?{name}"))
    rules.append(Rule("apache-2.0", TITLE, "apache", rf"apache {_VER}2(?: 0)?"))
    return rules


RULES: tuple[Rule, ...] = tuple(sorted(
    [Rule(label, priority, word, pattern) for label, priority, word, pattern in _SINGLE] + _creative_commons() + _families(),
    key=lambda rule: rule.priority))



def _rule_table(rules: tuple[Rule, ...]) -> Column:
    """All rules as one constant array."""
    return F.array(*[F.struct(
        F.lit(i).alias("rank"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
        F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern")) for i, r in enumerate(rules)])


def _starts(norm: Column, pattern: Column | str) -> Column:
    """Word numbers at which the matches begin; a mark that no word can hold is put before each match."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    marked = F.split(F.regexp_replace(norm, pattern, F.lit("\x01$0")), " ")
    return F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit("\x01")), i - 1).otherwise(-1)), lambda i: i >= 0)


def _n_spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The frame with a column `license`: struct(n_words, base_starts, base_labels, detections, score).

    `detections` holds what suppression leaves: (start, end, priority, rank, label), words from 0, end exclusive, sorted.
    `base_starts` holds the start of every base phrase, `base_labels` their sorted distinct labels. A missing or empty
    text has no words, no detections and score 0. Rows are independent: repeated rows get equal answers.
    """
    norm, kw, hits, spans, base, out = fresh(docs, "norm", "kw", "hits", "spans", "base", "license")
    keep = docs.columns
    words = F.trim(F.regexp_replace(F.lower(text_of(text)), BREAKS, " "))
    step = docs.withColumn(norm, F.concat(F.lit(" "), words, F.lit(" ")))
    n = F.col(norm)
    gate = "(?<= )(?:" + "|".join(sorted({r.keyword for r in rules} | {p.split()[0] for p in BASE})) + ")(?= )"
    step = step.withColumn(kw, F.array_distinct(F.regexp_extract_all(n, F.lit(gate), F.lit(0))))
    found = F.filter(_rule_table(rules), lambda r: F.array_contains(F.col(kw), r["keyword"]))
    matched = F.filter(F.transform(found, lambda r: F.struct(
        r["rank"].alias("rank"), r["priority"].alias("priority"), r["label"].alias("label"), r["pattern"].alias("pattern"),
        F.regexp_extract_all(n, r["pattern"], F.lit(0)).alias("m"))), lambda r: F.size(r["m"]) > 0)
    base_pattern = "(?<= )(?:" + "|".join(BASE) + ")(?= )"
    step = step.withColumn(hits, F.when(F.size(kw) > 0, matched)).withColumn(
        base, F.when(F.size(kw) > 0, F.when(n.rlike(base_pattern), _starts(n, base_pattern))))
    placed = F.flatten(F.transform(F.col(hits), lambda r: F.zip_with(
        _starts(n, r["pattern"]), r["m"], lambda s, m: F.struct(
            s.alias("start"), (-(s + _n_spaces(m) + 1)).alias("neg_end"), r["priority"].alias("priority"),
            r["rank"].alias("rank"), r["label"].alias("label")))))
    step = step.withColumn(spans, F.when(F.size(hits) > 0, F.array_sort(placed)))
    step = step.withColumn(spans, F.coalesce(F.expr(_suppress(spans)), F.expr(_NONE)))
    labels = F.array_compact(F.array(*[F.when(F.contains(n, F.lit(f" {p} ")), F.lit(label)) for p, label in BASE.items()]))
    base_labels = F.when(F.size(base) > 0, F.array_sort(labels)).otherwise(F.array().cast("array<string>"))
    confidence = F.array_max(F.transform(F.col(spans), lambda d: F.element_at(
        F.array(*[F.lit(CONFIDENCE[k]) for k in sorted(CONFIDENCE)]), d["priority"])))
    score = F.greatest(F.coalesce(confidence, F.lit(0.0)), F.when(F.size(base) > 0, BASE_CONFIDENCE).otherwise(0.0))
    return step.select(*[step[c] for c in keep], F.struct(
        F.when(F.length(n) > 2, _n_spaces(n) - 1).otherwise(0).cast("long").alias("n_words"),
        F.coalesce(F.col(base), F.array().cast("array<int>")).alias("base_starts"),
        base_labels.alias("base_labels"),
        F.transform(F.col(spans), lambda d: F.struct(
            d["start"].alias("start"), (-d["neg_end"]).alias("end"), d["priority"].alias("priority"), d["rank"].alias("rank"),
            d["label"].alias("label"))).alias("detections"),
        score.alias("score")).alias(out))


_SPAN = "struct<start:int,neg_end:int,priority:int,rank:int,label:string>"
_NONE = f"cast(array() as array<{_SPAN}>)"


def _suppress(spans: str) -> str:
    """One sweep over intervals sorted by start, longest first, keeping the furthest end per priority or better."""
    ends = ", ".join(f"'e{k}', 0" for k in CONFIDENCE)
    best = "CASE x.priority " + " ".join(f"WHEN {k} THEN a.e{k}" for k in CONFIDENCE) + " END"
    moved = ", ".join(f"'e{k}', CASE WHEN x.priority <= {k} THEN greatest(a.e{k}, -x.neg_end) ELSE a.e{k} END" for k in CONFIDENCE)
    return (f"aggregate({spans}, named_struct('kept', {_NONE}, {ends}), "
            f"(a, x) -> named_struct('kept', CASE WHEN {best} >= -x.neg_end THEN a.kept ELSE concat(a.kept, array(x)) END, {moved}), a -> a.kept)")
