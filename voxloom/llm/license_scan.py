"""License scanning with ordered signature rules (DataFrame functions only).

Each rule is a regular expression with keywords, a priority and a label: the
sentences by which licenses are known, written out by hand, and the forms in
which licenses are named, made from a table of their names.  A text is first
tested for a few gate keywords; in a text that has one, the rules
of which a keyword occurs are run, and a detection is suppressed when it lies
inside the interval of another of the same or a stronger priority.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WORD_CHAR = common.ALNUM_WORD_ANY_CASE[:-1]
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases whose every place counts, and their labels.
BASE = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}


class Rule(NamedTuple):
    name: str
    label: str
    priority: int  # 0 is strongest
    keywords: tuple[str, ...]  # lower case, without white space; one occurs wherever the regular expression matches
    regex: str  # a space stands for any white space


#: Fixed values: (label, SPDX name, keywords, title as a regular expression, versions that have a label of their own).
FAMILIES = [
    ("mit", "MIT", "mit|expat|x11", r"(?:mit|expat|x11)", ()),
    ("apache", "Apache", "apache", r"apache(?: software)?", ("1.0", "1.1", "2.0")),
    ("gpl", "GPL", "general public", r"(?:gnu )?general public", ("1", "2", "3")),
    ("gpl", "GPL", "gpl", r"(?:gnu )?gpl", ("1", "2", "3")),
    ("lgpl", "LGPL", "lesser general", r"(?:gnu )?lesser general public", ("2.1", "3")),
    ("lgpl", "LGPL", "lgpl", r"(?:gnu )?lgpl", ("2.1", "3")),
    ("agpl", "AGPL", "affero", r"(?:gnu )?affero general public", ("1", "3")),
    ("agpl", "AGPL", "agpl", r"(?:gnu )?agpl", ("1", "3")),
    ("gfdl", "GFDL", "free documentation", r"(?:gnu )?free documentation", ("1.1", "1.2", "1.3")),
    ("bsd", "BSD", "bsd", r"(?:new |modified |simplified |revised )?bsd(?:[- ][0234][- ]clause)?", ("2", "3", "4")),
    ("mpl", "MPL", "mozilla", r"mozilla public", ("1.0", "1.1", "2.0")),
    ("mpl", "MPL", "mpl", r"mpl", ("1.0", "1.1", "2.0")),
    ("epl", "EPL", "eclipse", r"eclipse public", ("1.0", "2.0")),
    ("edl", "EDL", "eclipse", r"eclipse distribution", ("1.0",)),
    ("cddl", "CDDL", "common development", r"common development and distribution", ("1.0", "1.1")),
    ("cpl", "CPL", "common public", r"common public", ("1.0",)),
    ("cpal", "CPAL", "common public attribution", r"common public attribution", ("1.0",)),
    ("eupl", "EUPL", "european union", r"european union public", ("1.0", "1.1", "1.2")),
    ("isc", "ISC", "isc", r"isc", ()),
    ("zlib", "Zlib", "zlib", r"zlib(?:/libpng)?", ()),
    ("boost", "BSL", "boost", r"boost software", ("1.0",)),
    ("artistic", "Artistic", "artistic", r"(?:perl )?artistic", ("1.0", "2.0")),
    ("python", "PSF", "python", r"python(?: software foundation)?", ("2.0",)),
    ("ruby", "Ruby", "ruby", r"ruby", ()),
    ("php", "PHP", "php", r"php", ("3.0", "3.01")),
    ("unlicense", "Unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", "WTFPL", "what the", r"do what the \w+ you want to public", ("2",)),
    ("openssl", "OpenSSL", "openssl", r"openssl", ()),
    ("postgresql", "PostgreSQL", "postgresql", r"postgresql", ()),
    ("ms-pl", "MS-PL", "microsoft public", r"microsoft public", ()),
    ("ms-rl", "MS-RL", "microsoft reciprocal", r"microsoft reciprocal", ()),
    ("afl", "AFL", "academic free", r"academic free", ("2.1", "3.0")),
    ("osl", "OSL", "open software", r"open software", ("2.1", "3.0")),
    ("ofl", "OFL", "open font", r"(?:sil )?open font", ("1.0", "1.1")),
    ("lppl", "LPPL", "latex project", r"latex project public", ("1.2", "1.3")),
    ("qpl", "QPL", "q public", r"q public", ("1.0",)),
    ("cecill", "CECILL", "cecill", r"cecill(?:-[bc])?", ("1.0", "2.0", "2.1")),
    ("mulan", "MulanPSL", "mulan", r"mulan(?: permissive software| psl)?", ("1", "2")),
    ("cc-by", "CC-BY", "attribution", r"(?:creative commons )?attribution", ("2.0", "3.0", "4.0")),
    ("cc-by-sa", "CC-BY-SA", "sharealike", r"(?:creative commons )?attribution[- ]sharealike", ("2.0", "3.0", "4.0")),
    ("cc-by-nc", "CC-BY-NC", "noncommercial", r"(?:creative commons )?attribution[- ]noncommercial", ("2.0", "3.0", "4.0")),
    ("cc-by-nd", "CC-BY-ND", "noderiv", r"(?:creative commons )?attribution[- ]noderiv(?:ative)?s", ("2.0", "3.0", "4.0")),
    ("cc0", "CC0", "cc0|zero", r"(?:creative commons )?(?:zero|cc0)", ("1.0",)),
    ("odbl", "ODbL", "open database", r"open database", ("1.0",)),
    ("sspl", "SSPL", "server side", r"server side public", ("1",)),
    ("busl", "BUSL", "business source", r"business source", ("1.1",)),
    ("elastic", "Elastic", "elastic", r"elastic", ("2.0",)),
]
#: Notices that are no title.
NOTICES = [
    Rule("all-rights", "proprietary", 3, ("reserved",), r"all rights reserved"),
    Rule("copyright", "copyright-notice", 3, ("copyright",), r"copyright (?:\(c\)|©)? ?(?:19|20)[0-9]{2}"),
    Rule("public-domain", "public-domain", 2, ("domain",), r"(?:dedicated|released|placed) (?:to|in|into) the public domain"),
    Rule("as-is", "warranty-disclaimer", 3, ("warrant",), r'provided "?as is"?,? without (?:any )?warrant(?:y|ies)'),
    Rule("mit-grant", "mit", 0, ("charge",), r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    Rule("bsd-grant", "bsd", 0, ("binary",), r"redistribution and use in source and binary forms"),
    Rule("isc-grant", "isc", 0, ("modify,",), r"permission to use, copy, modify, and(?:/or)? distribute this software"),
    Rule("gpl-grant", "gpl", 0, ("redistribute",), r"you can redistribute it and/or modify it under the terms of the gnu general public license"),
    Rule("apache-url", "apache-2.0", 0, ("apache.org/licenses",), r"https?://www\.apache\.org/licenses/license-2\.0"),
    Rule("gpl-url", "gpl", 1, ("gnu.org/licenses",), r"https?://www\.gnu\.org/licenses/(?:old-licenses/)?gpl[a-z0-9.-]*"),
    Rule("mit-url", "mit", 1, ("opensource.org/licenses",), r"https?://(?:www\.)?opensource\.org/licenses/mit[a-z.-]*"),
    Rule("cc-url", "creative-commons", 1, ("creativecommons.org",), r"https?://creativecommons\.org/(?:licenses|publicdomain)/[a-z-]+/[0-9.]+"),
    Rule("licensed-under", "unknown-license", 3, ("licensed",), r"(?:is|are) licensed under"),
]


#: Sentences that stand in the licenses themselves or in their notices (name, label, priority, keyword, regular expression).
SIGNATURES = [
    Rule(name, label, priority, (keyword,), regex)
    for name, label, priority, keyword, regex in [
        ("mit-deal", "mit", 0, "restriction", r"to deal in the software without restriction, including without limitation the rights"),
        ("mit-notice", "mit", 1, "substantial", r"shall be included in all copies or substantial portions of the software"),
        ("mit-holders", "mit", 1, "liable", r"in no event shall the authors or copyright holders be liable for any claim"),
        ("x11-name", "mit", 1, "consortium", r"except as contained in this notice, the names? of the x consortium shall not be used"),
        ("mit-0", "mit-0", 0, "mit-0", r"\bmit-0\b"),
        ("mit-no-attribution", "mit-0", 0, "attribution", r"\bmit no attribution\b"),
        ("bsd-source", "bsd", 0, "redistributions", r"redistributions of source code must retain the above copyright notice"),
        ("bsd-binary", "bsd", 0, "reproduce", r"redistributions in binary form must reproduce the above copyright notice"),
        ("bsd-endorse", "bsd-3", 0, "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
        ("bsd-advert", "bsd-4", 0, "advertising", r"all advertising materials mentioning features or use of this software must display"),
        ("bsd-0", "bsd-0", 0, "hereby", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted\."),
        ("bsd-regents", "bsd", 1, "regents", r"the regents of the university of california"),
        ("bsd-disclaimer", "bsd", 1, "contributors", r"this software is provided by the (?:copyright holders|regents) and contributors"),
        ("isc-fee", "isc", 1, "hereby", r"with or without fee is hereby granted, provided that the above copyright notice"),
        ("isc-disclaims", "isc", 1, "disclaims", r"the author disclaims all warranties with regard to this software"),
        ("apache-compliance", "apache-2.0", 0, "compliance", r"you may not use this file except in compliance with the license"),
        ("apache-basis", "apache-2.0", 1, "basis", r"distributed on an \"as is\" basis, without warranties or conditions of any kind"),
        ("apache-contributor", "apache-2.0", 1, "contributor", r"licensed to the apache software foundation \(asf\) under one or more contributor"),
        ("apache-1-ack", "apache-1.1", 0, "foundation", r"this product includes software developed by the apache software foundation"),
        ("apache-perpetual", "apache-2.0", 0, "perpetual", r"perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (?:copyright|patent) license"),
        ("gpl-free", "gpl", 0, "redistribute", r"is free software[:;,] you can redistribute it and/or modify"),
        ("gpl-hope", "gpl", 1, "hope", r"is distributed in the hope that it will be useful"),
        ("gpl-later", "gpl", 1, "option)", r"or \(at your option\) any later version"),
        ("gpl-received", "gpl", 1, "received", r"you should have received a copy of the gnu general public license"),
        ("gpl-preamble", "gpl", 0, "freedom", r"licenses for most software are designed to take away your freedom"),
        ("gpl-copyleft", "gpl", 0, "copyleft", r"the gnu general public license is a free, copyleft license"),
        ("gpl-only", "gpl-2", 0, "gpl-2.0", r"\bgpl-2\.0(?:-only|-or-later|\+)"),
        ("gpl3-only", "gpl-3", 0, "gpl-3.0", r"\bgpl-3\.0(?:-only|-or-later|\+)"),
        ("gplv2", "gpl-2", 1, "gplv2", r"\bgplv2\b"),
        ("gplv3", "gpl-3", 1, "gplv3", r"\bgplv3\b"),
        ("lgplv2", "lgpl-2.1", 1, "lgplv2", r"\blgplv2(?:\.1)?\b"),
        ("lgplv3", "lgpl-3", 1, "lgplv3", r"\blgplv3\b"),
        ("lgpl-received", "lgpl", 1, "received", r"you should have received a copy of the gnu (?:lesser|library) general public license"),
        ("lgpl-linking", "lgpl", 0, "linking", r"as a special exception, .{0,80}?linking (?:this library|the library) statically or dynamically"),
        ("agpl-network", "agpl", 0, "remotely", r"all users interacting with it remotely through a computer network"),
        ("agplv3", "agpl-3", 1, "agplv3", r"\bagplv3\b"),
        ("gfdl-invariant", "gfdl", 0, "invariant", r"with no invariant sections, (?:with )?no front-cover texts,? and (?:with )?no back-cover texts"),
        ("gfdl-copy", "gfdl", 0, "document", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation"),
        ("mpl-notice", "mpl-2.0", 0, "obtain", r"if a copy of the mpl was not distributed with this file, you can obtain one at"),
        ("mpl-subject", "mpl-2.0", 0, "subject", r"this source code form is subject to the terms of the mozilla public license"),
        ("mpl-1-contents", "mpl-1.1", 0, "contents", r"the contents of this file are subject to the mozilla public license version 1\.1"),
        ("mpl-url", "mpl", 1, "mozilla.org", r"https?://(?:www\.)?mozilla\.org/mpl/[0-9.]*"),
        ("mpl-incompatible", "mpl-2.0", 1, "incompatible", r"incompatible with secondary licenses"),
        ("epl-accompanying", "epl", 0, "accompanying", r"the accompanying materials are made available under the terms of the eclipse public license"),
        ("epl-url", "epl", 1, "eclipse.org/legal", r"https?://(?:www\.)?eclipse\.org/legal/epl-[a-z0-9.-]+"),
        ("cddl-contents", "cddl", 0, "development", r"subject to the terms of the common development and distribution license"),
        ("cddl-file", "cddl", 1, "usr/src", r"you can obtain a copy of the license at usr/src/opensolaris\.license"),
        ("eupl-licensed", "eupl", 0, "eupl", r"licensed under the eupl\b"),
        ("zlib-express", "zlib", 0, "express", r"this software is provided 'as-is', without any express or implied warranty"),
        ("zlib-origin", "zlib", 0, "misrepresented", r"the origin of this software must not be misrepresented"),
        ("zlib-altered", "zlib", 1, "altered", r"altered source versions must be plainly marked as such"),
        ("boost-grant", "boost", 0, "organization", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy"),
        ("boost-url", "boost-1.0", 0, "boost.org", r"https?://(?:www\.)?boost\.org/license_1_0\.txt"),
        ("artistic-intent", "artistic", 0, "intent", r"the intent of this document is to state the conditions under which a package may be copied"),
        ("perl-terms", "artistic", 1, "perl", r"under the same terms as perl itself"),
        ("python-psf", "python", 0, "licensee", r"psf hereby grants licensee a nonexclusive, royalty-free, world-wide license"),
        ("ruby-terms", "ruby", 1, "ruby", r"under the same terms as ruby\b"),
        ("php-url", "php", 0, "php.net/license", r"https?://(?:www\.)?php\.net/license/[0-9a-z_.]+"),
        ("unlicense-free", "unlicense", 0, "unencumbered", r"this is free and unencumbered software released into the public domain"),
        ("unlicense-anyone", "unlicense", 1, "anyone", r"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
        ("unlicense-url", "unlicense", 1, "unlicense.org", r"https?://(?:www\.)?unlicense\.org"),
        ("openssl-ack", "openssl", 0, "toolkit", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
        ("ssleay-ack", "openssl", 0, "cryptographic", r"this product includes cryptographic software written by eric young"),
        ("postgres-regents", "postgresql", 0, "agreement", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement"),
        ("hpnd-grant", "hpnd", 0, "documentation", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose and without fee"),
        ("ntp-grant", "ntp", 1, "representations", r"makes no representations about the suitability (?:of )?this software for any purpose"),
        ("curl-notice", "curl", 0, "holder", r"except as contained in this notice, the name of a copyright holder shall not be used in advertising"),
        ("libpng-notice", "libpng", 0, "png", r"the png reference library is supplied \"as is\""),
        ("jpeg-ack", "ijg", 0, "independent", r"this software is based in part on the work of the independent jpeg group"),
        ("freetype-ack", "freetype", 0, "freetype", r"portions of this software are copyright .{0,60}?the freetype project"),
        ("imagemagick", "imagemagick", 0, "imagemagick", r"\bimagemagick license\b"),
        ("w3c-notice", "w3c", 0, "w3c", r"\bw3c(?:\(r\)|®)? software (?:and document )?(?:notice and )?license\b"),
        ("unicode-data", "unicode", 0, "unicode", r"obtaining a copy of the unicode data files"),
        ("ofl-reserved", "ofl", 0, "reserved", r"with reserved font names? "),
        ("ofl-sold", "ofl", 0, "itself", r"neither the font software nor any of its individual components.{0,60}? may be sold by itself"),
        ("cc-by-notice", "cc-by", 1, "commons", r"licensed under (?:a|the) creative commons attribution(?: [0-9.]+)? (?:international|unported|generic)"),
        ("cc-short", "creative-commons", 1, "cc-by", r"\bcc-by(?:-(?:nc|nd|sa))*[- ][1-4]\.0\b"),
        ("cc0-waive", "cc0", 0, "waived", r"has waived all copyright and related or neighboring rights"),
        ("odc-by", "odc-by", 0, "commons", r"\bopen data commons attribution license\b"),
        ("odc-pddl", "pddl", 0, "dedication", r"\bopen data commons public domain dedication\b"),
        ("ms-rl-short", "ms-rl", 1, "ms-rl", r"\bms-rl\b"),
        ("busl-change", "busl", 0, "change", r"\bchange date: .{0,40}?change license: "),
        ("busl-grant", "busl", 1, "non-production", r"make non-production use of the licensed work"),
        ("elastic-may", "elastic", 0, "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
        ("commons-clause", "commons-clause", 0, "clause", r"\bcommons clause\b"),
        ("json-good", "json", 0, "evil", r"the software shall be used for good, not evil"),
        ("beerware", "beerware", 0, "ware", r"\bthe beer-?ware license\b"),
        ("llama-community", "llama", 0, "llama", r"\bllama [0-9.]+ (?:community )?license agreement\b"),
        ("openrail", "openrail", 0, "openrail", r"\b(?:creativeml |bigscience )?openrail(?:\+\+|-m)?\b"),
        ("all-permissive", "fsf-all-permissive", 0, "copying", r"copying and distribution of this file, with or without modification, are permitted in any medium"),
        ("proprietary-confidential", "proprietary", 1, "confidential", r"\bproprietary and confidential\b"),
        ("proprietary-unauthorized", "proprietary", 1, "unauthorized", r"unauthorized (?:copying|reproduction|distribution|use)(?: (?:of|or) \w+){0,6}? is (?:strictly )?prohibited"),
        ("proprietary-internal", "proprietary", 2, "internal", r"for internal use only"),
        ("noncommercial-use", "non-commercial", 2, "commercial", r"for (?:personal,? )?non-?commercial (?:use|purposes) only"),
        ("research-only", "research-only", 2, "research", r"for research purposes only"),
        ("patent-grant", "patent-grant", 2, "patent", r"hereby grants? .{0,80}?patent license"),
        ("permission-required", "permission-required", 3, "permission", r"without (?:the )?(?:prior |express )*written permission of"),
    ]
]


#: One of these occurs in every text that a rule of a family matches.
FAMILY_GATE = ["licens", "licenc"]
#: One of these occurs in nearly every license text; the keywords of rules whose regular expression holds none of them stand beside.
STEMS = [*FAMILY_GATE, "copyright", "permission", "software", "distribut", "warrant", "gpl"]
GATE = [*STEMS, "unauthorized", *sorted({k for r in NOTICES + SIGNATURES if not any(stem in r.regex for stem in STEMS) for k in r.keywords})]
CONFIDENCE = [0.99, 0.95, 0.85, 0.5]
DETECTION = "struct<start:int,until:int,priority:int,rule:string,label:string,end:int>"


#: Between two words: white space, with the marks of a comment or a quotation where a line was broken.
GAP_RUN = r"\s[\s#*/>;%|]*+"


def spaced(regex: str) -> str:
    """Spaces become runs of white space and comment marks; nothing that follows one begins with these, so runs are never tried shorter."""
    return regex.replace("[- ]", rf"(?:-|{GAP_RUN})").replace(" ?", rf"(?:{GAP_RUN})?+").replace(" ", GAP_RUN)


def default_rules() -> list[Rule]:
    """The families by the forms in which they are named, then the notices and signatures."""
    return family_rules() + signature_rules()


def signature_rules() -> list[Rule]:
    return [r._replace(regex=spaced(r.regex)) for r in NOTICES + SIGNATURES]


def family_rules() -> list[Rule]:
    rules = []
    for label, spdx, keyword, title, versions in FAMILIES:
        key = re.sub(r"\W+", "-", f"{label} {keyword.split('|')[0]}")
        keywords = tuple(max(k.split(), key=len) for k in keyword.split("|"))
        rules.append(Rule(f"{key}-title", label, 2, keywords, rf"\b{title} licen[cs]e\b"))
        rules.append(Rule(f"{key}-under", label, 1, keywords, rf"\blicen[cs]ed under (?:the )?(?:terms of the )?{title}(?: licen[cs]e)?\b"))
        rules.append(Rule(f"{key}-spdx", label, 0, ("spdx-license-identifier",), rf"spdx-license-identifier: ?{re.escape(spdx.lower())}(?:-[a-z0-9.]+)*"))
        for v in versions:
            rules.append(Rule(f"{key}-{v}", f"{label}-{v}", 0, keywords, rf"\b{title} licen[cs]e,? ?(?:\(?[a-z]{{2,6}}\)?,? )?(?:version|v\.?) ?{re.escape(v)}(?:\.0)?\b"))
    return [r._replace(regex=spaced(r.regex)) for r in rules]


def base_regex(phrases: list[tuple[str, ...]]) -> str:
    return rf"(?<!{WORD_CHAR})(?:{'|'.join(GAP.join(p) for p in phrases)})(?!{WORD_CHAR})"


def _detections(text: Column, low: Column, rules: list[Rule]) -> Column:
    table = F.array(*(F.struct(*((F.array(*map(F.lit, v)) if k == "keywords" else F.lit(v)).alias(k) for k, v in (r._asdict() | {"regex": f"(?i){r.regex}"}).items())) for r in rules))
    run = lambda r: F.transform(common.occurrences(text, r["regex"]), lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("until"), r["priority"].alias("priority"), r["name"].alias("rule"), r["label"].alias("label"), x["end"].alias("end")))
    return F.flatten(F.transform(F.filter(table, lambda r: F.exists(r["keywords"], lambda k: F.contains(low, k))), run))


def _unsuppressed(found: Column) -> Column:
    """Containers come first in the order (start, longer first, priority); reach[p] is the furthest end seen at priority p."""
    inside = lambda acc, d: F.exists(F.slice(acc["reach"], 1, d["priority"] + 1), lambda e: e >= d["end"])
    step = lambda acc, d: F.struct(
        F.transform(acc["reach"], lambda e, p: F.when(p == d["priority"], F.greatest(e, d["end"])).otherwise(e)).alias("reach"),
        F.when(inside(acc, d), acc["kept"]).otherwise(F.array_append(acc["kept"], d)).alias("kept"),
    )
    start = F.struct(F.array(*(F.lit(-1) for _ in CONFIDENCE)).alias("reach"), F.array().cast(f"array<{DETECTION}>").alias("kept"))
    return F.aggregate(found, start, step, lambda acc: acc["kept"])


def license_scan(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, detections, labels and score to every row.

    Null texts count as empty: no words, no places, null first and last word,
    no labels, score 0.  Of detections with the same interval the stronger
    priority stays, then the first by rule name.  score is the confidence of
    the strongest detection, 0.6 where only a base phrase stands.  detections
    hold code point offsets.  Columns named like the added ones are an error.
    """
    common.require_absent(docs, "n_words", "n_base", "first_word", "last_word", "base_labels", "detections", "labels", "score")
    content, low, n_base, found = (common.fresh_name(docs, x) for x in ("content", "low", "places", "found"))
    words = lambda c: F.regexp_count(c, F.lit(f"{WORD_CHAR}+")).cast("long")
    any_base = base_regex(list(BASE.values()))
    step = docs.withColumn(content, common.text_or_empty(text)).withColumn(low, F.lower(content))
    licensed = F.contains(F.col(low), F.lit("license"))
    has = lambda keywords: reduce(Column.__or__, (F.contains(F.col(low), F.lit(k)) for k in keywords))
    none = F.array().cast(f"array<{DETECTION}>")
    detect = lambda some: _detections(F.col(content), F.col(low), some)
    # Without a gate keyword no rule matches, and without one of theirs none of the families'; rules of the caller are all run.
    raw = F.concat(F.when(has(FAMILY_GATE), detect(family_rules())).otherwise(none), F.when(has(GATE), detect(signature_rules())).otherwise(none)) if rules is None else detect(rules)
    step = step.withColumn(n_base, F.when(licensed, F.regexp_count(content, F.lit(f"(?i){any_base}"))).otherwise(F.lit(0)))
    step = step.withColumn(found, raw)
    step = step.withColumn(found, F.when(F.size(found) > 0, _unsuppressed(F.array_sort(found))).otherwise(none))
    base_labels = F.when(F.col(n_base) > 0, F.array_compact(F.array(*(F.when(F.col(content).rlike(f"(?i){base_regex([p])}"), F.lit(label)) for label, p in sorted(BASE.items()))))).otherwise(F.array().cast("array<string>"))
    before = lambda any_text: F.when(F.col(n_base) > 0, words(F.regexp_extract(content, f"(?is)^({any_text}){any_base}", 1)))
    strongest = F.array_min(F.transform(found, lambda d: d["priority"]))
    score = F.coalesce(F.get(F.array(*map(F.lit, CONFIDENCE)), strongest), F.when(F.col(n_base) > 0, F.lit(0.6)), F.lit(0.0))
    return step.select(
        *docs.columns,
        words(F.col(content)).alias("n_words"),
        F.col(n_base).cast("long").alias("n_base"),
        before(".*?").alias("first_word"),
        before(".*").alias("last_word"),
        base_labels.alias("base_labels"),
        F.transform(found, lambda d: F.struct(d["start"].alias("start"), d["end"].alias("end"), d["priority"].alias("priority"), d["rule"].alias("rule"), d["label"].alias("label"))).alias("detections"),
        F.array_sort(F.array_union(base_labels, F.transform(found, lambda d: d["label"]))).alias("labels"),
        score.alias("score"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
