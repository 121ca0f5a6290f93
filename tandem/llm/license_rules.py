"""Licence signature rules: written by hand, as names of licences and the
phrasings in which a licence is granted, named or referred to.

Patterns are matched on a document's lower-cased words joined by one space,
and always between spaces.  ``keyword`` must occur for a rule to be tried, and
one of ``GATES`` occurs wherever any rule matches.
"""

from __future__ import annotations

from typing import NamedTuple

#: Substrings of which one stands in every text that a rule can match.
GATES = ("licen", "cc by", "cc0", "gpl", "public domain", "copyright", "permission", "redistribut",
         "warrant", "all rights", "copyleft", "free software", "bsd", "endorse", "advertising materials", "copying")

#: label: base phrase (one label for each phrase)
BASE = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}


class Rule(NamedTuple):
    """A higher priority suppresses detections that lie inside its own."""
    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float
    base: bool


_VER = r"(?: (?:version |v)?[0-9]+(?: [0-9]+)*)?"

#: label, keyword, name (a name without "licence" in it is only taken beside that word)
NAMES = [
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e"),
    ("gpl", "gpl", r"(?:gnu )?gpl(?:v?[123])?"),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?:v?[23])?"),
    ("agpl", "general public", r"(?:gnu )?affero general public licen[sc]e"),
    ("agpl", "agpl", r"(?:gnu )?agpl(?:v?3)?"),
    ("gfdl", "documentation", r"gnu free documentation licen[sc]e"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e"),
    ("mit", "mit", r"mit(?: x11)? licen[sc]e"),
    ("mit", "expat", r"expat(?: x11)? licen[sc]e"),
    ("mit-0", "mit", r"mit (?:0|no attribution) licen[sc]e"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|simplified bsd|freebsd)(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|original bsd)(?: licen[sc]e)?"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("mpl", "mpl", r"mpl(?: [12] [01])?"),
    ("epl", "eclipse", r"eclipse (?:public|distribution) licen[sc]e"),
    ("eupl", "european", r"european union public licen[sc]e"),
    ("cddl", "common", r"common development and distribution licen[sc]e"),
    ("cpl", "common", r"common public licen[sc]e"),
    ("artistic", "artistic", r"(?:perl )?artistic licen[sc]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("boost", "boost", r"boost software licen[sc]e"),
    ("python", "python", r"python(?: software foundation)? licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("php", "php", r"php licen[sc]e"),
    ("openssl", "openssl", r"openssl(?: ssleay)? licen[sc]e"),
    ("ofl", "font", r"(?:sil )?open font licen[sc]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e"),
    ("w3c", "w3c", r"w3c(?: software)?(?: notice and)? licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ms-pl", "microsoft", r"microsoft (?:public|reciprocal) licen[sc]e"),
    ("apsl", "apple", r"apple public source licen[sc]e"),
    ("osl", "open software", r"open software licen[sc]e"),
    ("afl", "academic", r"academic free licen[sc]e"),
    ("odbl", "database", r"open (?:data commons )?(?:open )?database licen[sc]e"),
    ("odc-by", "data commons", r"open data commons attribution licen[sc]e"),
    ("ogl", "government", r"open government licen[sc]e"),
    ("cecill", "cecill", r"cecill(?: [abc])?"),
    ("sspl", "server side", r"server side public licen[sc]e"),
    ("bsl", "business source", r"business source licen[sc]e"),
    ("elastic", "elastic", r"elastic licen[sc]e"),
    ("cc0", "cc0", r"(?:creative commons )?cc0(?: universal)?"),
    ("cc-by", "cc by", r"(?:creative commons )?cc by"),
    ("cc-by-sa", "cc by sa", r"(?:creative commons )?cc by sa"),
    ("cc-by-nd", "cc by nd", r"(?:creative commons )?cc by nd"),
    ("cc-by-nc", "cc by nc", r"(?:creative commons )?cc by nc"),
    ("cc-by-nc-sa", "cc by nc sa", r"(?:creative commons )?cc by nc sa"),
    ("cc-by-nc-nd", "cc by nc nd", r"(?:creative commons )?cc by nc nd"),
    ("cc-by", "attribution", r"creative commons attribution"),
    ("cc-by-sa", "share", r"creative commons attribution share ?alike"),
    ("cc-by-nd", "deriv", r"creative commons attribution no ?deriv[a-z]*"),
    ("cc-by-nc", "commercial", r"creative commons attribution non ?commercial"),
    ("cc-by-nc-sa", "commercial", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "commercial", r"creative commons attribution non ?commercial no ?deriv[a-z]*"),
    ("public-domain", "public domain", r"public domain"),
    ("proprietary", "proprietary", r"proprietary licen[sc]e"),
]

#: priority, weight, phrasing around a name
PHRASINGS = [
    (2, 0.6, r"(?:the )?{name}{ver}(?: licen[sc]es?)?"),
    (4, 0.95, r"(?:licen[sc]ed|released|distributed|made available|published|provided|covered|redistributed) "
              r"(?:[a-z0-9]+ ){{0,3}}?(?:under|by|with) (?:a |an |the )?(?:terms (?:and conditions )?of (?:the )?)?"
              r"{name}{ver}(?: licen[sc]es?)?"),
    (3, 0.8, r"(?:see|read|refer to|copy of|terms of|text of) (?:the )?{name}{ver}(?: licen[sc]es?)?"),
    (5, 1.0, r"spdx licen[sc]e identifier {name}{ver}(?: (?:only|or later))?"),
]

#: label, keyword, pattern, priority, weight: whole notices and markers
NOTICES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 6, 1.0),
    ("isc", "permission to use", r"permission to use copy modify and(?: or)? distribute this software for any purpose", 6, 1.0),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification", 6, 0.95),
    ("bsd-3-clause", "endorse", r"neither the name of (?:[a-z0-9]+ ){1,12}nor the names of its contributors may be used to endorse", 6, 1.0),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software", 6, 1.0),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify", 6, 0.95),
    ("lgpl", "free software", r"this library is free software you can redistribute it and or modify", 6, 0.95),
    ("gpl", "later version", r"either version [123](?: [0-9])? of the licen[sc]e or at your option any later version", 6, 0.9),
    ("apache", "in compliance with", r"you may not use this file except in compliance with the licen[sc]e", 6, 0.95),
    ("mpl", "source code form", r"this source code form is subject to the terms of the mozilla public licen[sc]e", 6, 1.0),
    ("boost", "boost", r"distributed under the boost software licen[sc]e", 6, 1.0),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty", 6, 0.85),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 6, 1.0),
    ("wtfpl", "what the", r"do what the [a-z]+ you want to public licen[sc]e", 6, 1.0),
    ("public-domain", "public domain", r"(?:dedicated|released|placed) (?:in|to|into) the public domain", 4, 0.9),
    ("warranty-disclaimer", "warrant", r"without warrant(?:y|ies)(?: or conditions)? of any kind", 1, 0.3),
    ("warranty-disclaimer", "merchantability", r"implied warrant(?:y|ies) of merchantability", 1, 0.3),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}", 1, 0.3),
    ("all-rights-reserved", "all rights", r"all rights reserved", 1, 0.4),
    ("copyleft", "copyleft", r"copyleft", 1, 0.3),
    ("licensed", "licen", r"(?:this work|this software|this document|this text) is licen[sc]ed", 1, 0.3),
    ("see-license", "licen", r"(?:see|read) (?:the )?licen[sc]e (?:file|txt|md)", 1, 0.4),
    ("see-license", "copying", r"(?:see|read) (?:the )?copying (?:file|txt|md)", 1, 0.4),
    ("license-file", "licen", r"licen[sc]e file", 0, 0.2),
]


def _named() -> list[Rule]:
    out = []
    for label, keyword, name in NAMES:
        alone = any(g in name for g in ("licen", "gpl", "cc by", "cc0", "public domain"))
        for k, (priority, weight, phrase) in enumerate(PHRASINGS):
            pattern = phrase.format(name=name, ver=_VER)
            if k == 0 and not alone:
                pattern = rf"{name}{_VER} licen[sc]e"
            elif k in (1, 2) and not alone:
                pattern = pattern.removesuffix("(?: licen[sc]es?)?") + " licen[sc]es?"
            out.append(Rule(label, keyword, pattern, priority, weight, False))
    return out


def rules() -> list[Rule]:
    """All rules in order; earlier ones win between equal intervals of one priority."""
    base = [Rule(k, v, v, 1, 0.5, True) for k, v in BASE.items()]
    return base + _named() + [Rule(*x, False) for x in NOTICES]
