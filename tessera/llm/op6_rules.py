"""Tables of the license scan: base phrases, identifiers, written rules."""

#: Base phrases and labels (fixed values of the contract).
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Public license identifiers that a tag may name.
SPDX_IDS = """0BSD AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0 APSL-2.0 Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0
BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1
CAL-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0
CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0
CDDL-1.0 CDDL-1.1 CDLA-Permissive-1.0 CDLA-Permissive-2.0 CDLA-Sharing-1.0 CECILL-2.1 CECILL-B CECILL-C CERN-OHL-P-2.0
CERN-OHL-S-2.0 CERN-OHL-W-2.0 CPAL-1.0 CPL-1.0 ECL-2.0 EFL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FSFAP
GFDL-1.1 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 HPND ICU IJG Intel IPL-1.0 ISC LGPL-2.0 LGPL-2.1 LGPL-3.0 LPL-1.02
LPPL-1.3c MirOS MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA NOSL NPL-1.1 ODbL-1.0 ODC-By-1.0 OFL-1.1
OGL-UK-3.0 OLDAP-2.8 OpenSSL OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 RPL-1.5 RPSL-1.0
Ruby SISSL Sleepycat SPL-1.0 SSPL-1.0 TCL UCL-1.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Xnet Zend-2.0
Zlib ZPL-2.1""".split()

_CCV = "(?: (?:[1-4] [05]))?(?: (?:international|unported|generic))?"


def _cc(parts: str) -> str:
    return f"creative commons attribution{parts}"


#: (label, confidence, keyword, pattern).  A blank in a pattern is any run of
#: separators; keywords are words that every match holds.
WRITTEN = [
    # GNU general public licenses
    ("gpl-3.0", .95, "gnu", "gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: version| v) 3(?: of the license)?(?: or (?:at your option )?any later version)?"),
    ("gpl-3.0", .95, "gplv3", "(?:gnu )?gplv3"),
    ("gpl-3.0", .9, "gpl", "(?:gnu )?gpl (?:version 3|v 3|3 0|3)"),
    ("gpl-3.0", .9, "gnu", "gnu org licenses gpl 3 0(?: en)?(?: html| txt)?"),
    ("gpl-2.0", .95, "gnu", "gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: version| v) 2(?: of the license)?(?: or (?:at your option )?any later version)?"),
    ("gpl-2.0", .95, "gplv2", "(?:gnu )?gplv2"),
    ("gpl-2.0", .9, "gpl", "(?:gnu )?gpl (?:version 2|v 2|2 0|2)"),
    ("gpl-2.0", .9, "gnu", "gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?"),
    ("gpl-1.0", .95, "gnu", "gnu general public licen[sc]e(?: version| v) 1"),
    ("gpl", .8, "gnu", "gnu general public licen[sc]e"),
    ("gpl", .75, "gpl", "(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?(?:gnu )?gpl"),
    ("gpl", .7, "gnu", "gnu gpl"),
    ("gpl", .7, "gnu", "gnu org licenses gpl(?: html| txt)?"),
    ("gpl", .6, "copyleft", "strong copyleft licen[sc]e"),
    ("gpl", .7, "gnu", "licence publique générale gnu"),
    ("gpl", .7, "gnu", "licencia pública general de gnu"),
    # lesser, affero, documentation
    ("lgpl-3.0", .95, "lesser", "gnu lesser general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: version| v) 3(?: of the license)?"),
    ("lgpl-2.1", .95, "lesser", "gnu lesser general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: version| v) 2 1(?: of the license)?"),
    ("lgpl-2.0", .95, "library", "gnu library general public licen[sc]e(?: version 2)?"),
    ("lgpl-3.0", .95, "lgplv3", "(?:gnu )?lgplv3"),
    ("lgpl-2.1", .95, "lgpl", "(?:gnu )?lgplv?2 1"),
    ("lgpl-3.0", .9, "lgpl", "lgpl (?:version 3|v 3|3 0|3)"),
    ("lgpl-2.1", .9, "lgpl", "lgpl (?:version 2 1|v 2 1|2 1)"),
    ("lgpl", .85, "lesser", "gnu lesser general public licen[sc]e"),
    ("lgpl", .7, "lgpl", "(?:gnu )?lgpl"),
    ("lgpl", .8, "lgpl", "gnu org licenses lgpl(?: html| txt)?"),
    ("agpl-3.0", .95, "affero", "gnu affero general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: version| v) 3(?: of the license)?"),
    ("agpl-3.0", .95, "agplv3", "(?:gnu )?agplv3"),
    ("agpl-3.0", .9, "agpl", "agpl (?:version 3|v 3|3 0|3)"),
    ("agpl", .85, "affero", "(?:gnu )?affero general public licen[sc]e"),
    ("agpl", .7, "agpl", "(?:gnu )?agpl"),
    ("gfdl-1.3", .95, "gnu", "gnu free documentation licen[sc]e version 1 3"),
    ("gfdl-1.2", .95, "gnu", "gnu free documentation licen[sc]e version 1 2"),
    ("gfdl-1.1", .95, "gnu", "gnu free documentation licen[sc]e version 1 1"),
    ("gfdl", .85, "gnu", "gnu free documentation licen[sc]e"),
    ("gfdl", .7, "gfdl", "(?:gnu )?gfdl"),
    ("fsfap", .8, "copying", "copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("autoconf-exception", .8, "autoconf", "generated by autoconf you may include it under the same distribution terms"),
    ("classpath-exception", .85, "linking", "linking this library statically or dynamically with other modules"),
    # Apache
    ("apache-2.0", .95, "apache", "apache licen[sc]e,? ?(?:version|v|ver)? ?2(?: 0)?"),
    ("apache-2.0", .9, "apache", "apache org licenses license 2 0(?: txt| html)?"),
    ("apache-2.0", .9, "apache", "apache 2(?: 0)?(?: software)? licen[sc]e"),
    ("apache-2.0", .9, "asl", "asl 2 0"),
    ("apache-2.0", .85, "unless", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-1.1", .95, "apache", "apache (?:software )?licen[sc]e,? ?(?:version|v)? ?1 1"),
    ("apache-1.0", .95, "apache", "apache (?:software )?licen[sc]e,? ?(?:version|v)? ?1 0"),
    ("apache", .8, "apache", "apache (?:software )?licen[sc]e"),
    ("apache", .7, "apache", "(?:licensed|released) under (?:the )?apache"),
    ("apache", .6, "apache", "this product includes software developed by the apache software foundation"),
    # MIT family
    ("mit", .9, "mit", "the mit licen[sc]e(?: mit)?"),
    ("mit", .85, "mit", "mit licen[sc]e"),
    ("mit", .9, "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", .85, "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", .85, "opensource", "opensource org licenses mit(?: license)?(?: php| html)?"),
    ("mit", .75, "mit", "(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit"),
    ("mit", .7, "expat", "expat licen[sc]e"),
    ("mit", .7, "mit", "licence mit"),
    ("mit", .7, "mit", "licencia mit"),
    ("mit", .7, "mit", "mit lizenz"),
    ("mit-0", .95, "mit", "mit no attribution(?: licen[sc]e)?"),
    ("mit-modern", .9, "mit", "modern mit licen[sc]e"),
    ("x11", .85, "x11", "x11 licen[sc]e"),
    ("x11", .8, "consortium", "except as contained in this notice the name of the x consortium shall not be used"),
    ("isc", .9, "isc", "isc licen[sc]e"),
    ("isc", .85, "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", .8, "permission", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("ncsa", .9, "illinois", "university of illinois ncsa open source licen[sc]e"),
    ("ncsa", .8, "ncsa", "ncsa open source licen[sc]e"),
    # BSD family
    ("0bsd", .95, "bsd", "(?:0bsd|bsd zero clause licen[sc]e|zero clause bsd)"),
    ("0bsd", .9, "0bsd", "0bsd"),
    ("bsd-2-clause", .95, "bsd", "bsd 2 clause(?: simplified)?(?: licen[sc]e)?"),
    ("bsd-2-clause", .9, "bsd", "(?:2|two) clause bsd(?: licen[sc]e)?"),
    ("bsd-2-clause", .85, "bsd", "simplified bsd(?: licen[sc]e)?"),
    ("bsd-2-clause", .8, "freebsd", "freebsd licen[sc]e"),
    ("bsd-3-clause", .95, "bsd", "bsd 3 clause(?: new| revised| new or revised)?(?: licen[sc]e)?"),
    ("bsd-3-clause", .9, "bsd", "(?:3|three) clause bsd(?: licen[sc]e)?"),
    ("bsd-3-clause", .85, "bsd", "(?:new|revised|modified) bsd licen[sc]e"),
    ("bsd-3-clause", .85, "endorse", "neither the name of [0-9a-z\x80-\xff]+(?: [0-9a-z\x80-\xff]+){0,8} nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", .95, "bsd", "bsd 4 clause(?: original| old)?(?: licen[sc]e)?"),
    ("bsd-4-clause", .9, "bsd", "(?:4|four) clause bsd(?: licen[sc]e)?"),
    ("bsd-4-clause", .85, "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment"),
    ("bsd", .75, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", .75, "bsd", "bsd(?: style)? licen[sc]e"),
    ("bsd", .65, "bsd", "(?:licensed|released) under (?:the )?bsd"),
    ("bsd", .75, "opensource", "opensource org licenses bsd license(?: php)?"),
    ("bsd", .65, "bsd", "licence bsd"),
    ("bsd", .65, "bsd", "bsd lizenz"),
    # Creative Commons
    ("cc0-1.0", .95, "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", .9, "creative", "creative commons zero(?: v?1 0)?(?: universal)?"),
    ("cc0-1.0", .9, "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("cc-pdm", .9, "creativecommons", "creativecommons org publicdomain mark 1 0"),
    ("cc-by-nc-nd", .95, "creative", _cc(" non ?commercial no ?deriv(?:ative)?s?(?: works)?" + _CCV)),
    ("cc-by-nc-sa", .95, "creative", _cc(" non ?commercial share ?alike" + _CCV)),
    ("cc-by-nc", .93, "creative", _cc(" non ?commercial" + _CCV)),
    ("cc-by-nd", .93, "creative", _cc(" no ?deriv(?:ative)?s?(?: works)?" + _CCV)),
    ("cc-by-sa", .93, "creative", _cc(" share ?alike" + _CCV)),
    ("cc-by", .9, "creative", _cc(_CCV + "(?: licen[sc]e)?")),
    ("cc-by-nc-nd", .93, "cc", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", .93, "cc", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", .92, "cc", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", .92, "cc", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", .92, "cc", "cc by sa(?: [1-4] [05])?"),
    ("cc-by", .85, "cc", "cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", .93, "creativecommons", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc-by-nc-sa", .93, "creativecommons", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc", .92, "creativecommons", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nd", .92, "creativecommons", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-sa", .92, "creativecommons", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by", .9, "creativecommons", "creativecommons org licenses by [1-4] [05]"),
    ("cc", .6, "creative", "creative commons licen[sc]e"),
    ("cc", .55, "creative", "licence creative commons"),
    ("cc", .55, "creative", "licencia creative commons"),
    ("cc", .55, "creative", "creative commons lizenz"),
    ("cc", .5, "creativecommons", "creativecommons org"),
    # Mozilla, Eclipse, Sun, IBM and other file-level licenses
    ("mpl-2.0", .95, "mozilla", "mozilla public licen[sc]e,? ?(?:version|v)? ?2 0"),
    ("mpl-1.1", .95, "mozilla", "mozilla public licen[sc]e,? ?(?:version|v)? ?1 1"),
    ("mpl-1.0", .95, "mozilla", "mozilla public licen[sc]e,? ?(?:version|v)? ?1 0"),
    ("mpl", .85, "mozilla", "mozilla public licen[sc]e"),
    ("mpl-2.0", .9, "mozilla", "(?:www )?mozilla org (?:en us )?mpl 2 0"),
    ("mpl", .7, "mozilla", "(?:www )?mozilla org mpl"),
    ("mpl", .65, "mplv2", "mplv2"),
    ("npl-1.1", .9, "netscape", "netscape public licen[sc]e(?: version 1 1)?"),
    ("epl-2.0", .95, "eclipse", "eclipse public licen[sc]e,? ?(?:version|v)? ?2 0"),
    ("epl-1.0", .95, "eclipse", "eclipse public licen[sc]e,? ?(?:version|v)? ?1 0"),
    ("epl", .85, "eclipse", "eclipse public licen[sc]e"),
    ("epl-2.0", .9, "eclipse", "eclipse org legal epl 2 0"),
    ("epl-1.0", .9, "eclipse", "eclipse org legal epl v10(?: html)?"),
    ("edl-1.0", .9, "eclipse", "eclipse distribution licen[sc]e(?: v 1 0)?"),
    ("cddl-1.1", .95, "cddl", "cddl(?: version)? 1 1"),
    ("cddl-1.0", .95, "cddl", "cddl(?: version)? 1 0"),
    ("cddl", .85, "development", "common development and distribution licen[sc]e"),
    ("cddl", .7, "cddl", "cddl"),
    ("cpl-1.0", .9, "common", "common public licen[sc]e(?: version)?(?: 1 0)?"),
    ("ipl-1.0", .9, "ibm", "ibm public licen[sc]e"),
    ("spl-1.0", .9, "sun", "sun public licen[sc]e"),
    ("sissl", .9, "sun", "sun industry standards source licen[sc]e"),
    ("apsl-2.0", .9, "apple", "apple public source licen[sc]e"),
    ("ms-pl", .9, "microsoft", "microsoft public licen[sc]e"),
    ("ms-pl", .8, "ms", "ms pl"),
    ("ms-rl", .9, "microsoft", "microsoft reciprocal licen[sc]e"),
    ("ms-eula", .7, "microsoft", "microsoft software licen[sc]e terms"),
    ("eupl-1.2", .95, "european", "european union public licen[sc]e,? ?(?:version|v)? ?1 2"),
    ("eupl-1.1", .95, "european", "european union public licen[sc]e,? ?(?:version|v)? ?1 1"),
    ("eupl", .85, "european", "european union public licen[sc]e"),
    ("eupl", .7, "eupl", "eupl"),
    ("osl-3.0", .95, "open", "open software licen[sc]e,? ?(?:version|v)? ?3 0"),
    ("osl-2.1", .95, "open", "open software licen[sc]e,? ?(?:version|v)? ?2 1"),
    ("osl", .85, "open", "open software licen[sc]e"),
    ("afl-3.0", .95, "academic", "academic free licen[sc]e,? ?(?:version|v)? ?3 0"),
    ("afl-2.1", .95, "academic", "academic free licen[sc]e,? ?(?:version|v)? ?2 1"),
    ("afl", .85, "academic", "academic free licen[sc]e"),
    ("ecl-2.0", .9, "educational", "educational community licen[sc]e"),
    ("artistic-2.0", .95, "artistic", "artistic licen[sc]e,? ?(?:version|v)? ?2(?: 0)?"),
    ("artistic-1.0", .95, "artistic", "artistic licen[sc]e,? ?(?:version|v)? ?1 0"),
    ("artistic", .85, "artistic", "(?:perl )?artistic licen[sc]e"),
    ("artistic", .7, "perl", "under the same terms as perl(?: itself)?"),
    ("clarified-artistic", .9, "artistic", "clarified artistic licen[sc]e"),
    ("cpal-1.0", .9, "common", "common public attribution licen[sc]e"),
    ("rpl-1.5", .9, "reciprocal", "reciprocal public licen[sc]e"),
    ("qpl-1.0", .9, "q", "q public licen[sc]e"),
    ("upl-1.0", .9, "universal", "universal permissive licen[sc]e"),
    ("ucl-1.0", .9, "upstream", "upstream compatibility licen[sc]e"),
    ("lppl-1.3c", .95, "latex", "latex project public licen[sc]e,? ?(?:version|v)? ?1 3c"),
    ("lppl", .85, "latex", "latex project public licen[sc]e"),
    ("cecill-b", .9, "cecill", "cecill b(?: licen[sc]e)?"),
    ("cecill-c", .9, "cecill", "cecill c(?: licen[sc]e)?"),
    ("cecill", .8, "cecill", "cecill(?: licen[sc]e)?"),
    ("mulan-2.0", .9, "mulan", "mulan (?:psl|permissive software licen[sc]e)(?: v2)?"),
    ("blueoak-1.0", .9, "oak", "blue oak model licen[sc]e"),
    ("w3c", .9, "w3c", "w3c (?:software )?(?:notice and )?licen[sc]e"),
    ("zlib", .9, "zlib", "zlib(?: libpng)? licen[sc]e"),
    ("zlib", .85, "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("libpng", .85, "libpng", "libpng licen[sc]e"),
    ("bsl-1.0", .95, "boost", "boost software licen[sc]e(?: version 1 0)?"),
    ("bsl-1.0", .85, "boost", "boost org license 1 0(?: txt)?"),
    ("busl-1.1", .95, "business", "business source licen[sc]e(?: 1 1)?"),
    ("elastic-2.0", .9, "elastic", "elastic licen[sc]e(?: 2 0| v2)?"),
    ("sspl-1.0", .9, "server", "server side public licen[sc]e"),
    ("sspl-1.0", .8, "sspl", "sspl"),
    ("commons-clause", .9, "commons", "commons clause(?: licen[sc]e condition)?"),
    ("polyform-nc", .9, "polyform", "polyform noncommercial licen[sc]e"),
    ("polyform", .8, "polyform", "polyform [0-9a-z]+(?: [0-9a-z]+)? licen[sc]e"),
    ("unlicense", .9, "unlicense", "the unlicense"),
    ("unlicense", .85, "unencumbered", "free and unencumbered software released into the public domain"),
    ("unlicense", .8, "unlicense", "unlicense org"),
    ("wtfpl", .9, "wtfpl", "wtfpl"),
    ("wtfpl", .85, "fuck", "do what the fuck you want to public licen[sc]e"),
    ("public-domain", .7, "public", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", .5, "public", "public domain"),
    ("public-domain", .5, "domaine", "domaine public"),
    ("public-domain", .5, "dominio", "dominio público"),
    ("public-domain", .5, "gemeinfrei", "gemeinfrei"),
    ("beerware", .85, "beer", "beer ?ware(?: licen[sc]e)?"),
    ("json", .85, "evil", "the software shall be used for good not evil"),
    ("openssl", .9, "openssl", "openssl licen[sc]e"),
    ("ssleay", .85, "eric", "this product includes cryptographic software written by eric young"),
    ("php-3.01", .95, "php", "php licen[sc]e,? ?(?:version|v)? ?3 01"),
    ("php", .85, "php", "php licen[sc]e"),
    ("python-2.0", .9, "python", "python software foundation licen[sc]e(?: version 2)?"),
    ("python-2.0", .8, "psf", "psf licen[sc]e"),
    ("ruby", .85, "ruby", "ruby licen[sc]e"),
    ("postgresql", .9, "postgresql", "postgresql licen[sc]e"),
    ("sleepycat", .9, "sleepycat", "sleepycat licen[sc]e"),
    ("openldap", .9, "openldap", "openldap public licen[sc]e"),
    ("zpl-2.1", .9, "zope", "zope public licen[sc]e"),
    ("zend-2.0", .9, "zend", "zend engine licen[sc]e"),
    ("vim", .9, "vim", "vim licen[sc]e"),
    ("tcl", .85, "tcl", "tcl tk licen[sc]e"),
    ("icu", .85, "icu", "icu licen[sc]e"),
    ("unicode", .85, "unicode", "unicode(?: inc)? licen[sc]e agreement"),
    ("ijg", .85, "jpeg", "independent jpeg group(?: s)?(?: software)?(?: licen[sc]e)?"),
    ("curl", .85, "curl", "curl licen[sc]e"),
    ("info-zip", .85, "zip", "info zip licen[sc]e"),
    ("bzip2", .85, "bzip2", "bzip2(?: and libbzip2)? licen[sc]e"),
    # data, content, fonts, hardware, models
    ("odbl-1.0", .9, "database", "open (?:data commons open )?database licen[sc]e"),
    ("odbl-1.0", .8, "odbl", "odbl"),
    ("odc-by-1.0", .9, "commons", "open data commons attribution licen[sc]e"),
    ("pddl-1.0", .9, "commons", "(?:open data commons )?public domain dedication and licen[sc]e"),
    ("cdla-permissive", .9, "community", "community data licen[sc]e agreement permissive"),
    ("cdla-sharing", .9, "community", "community data licen[sc]e agreement sharing"),
    ("ogl-uk", .85, "government", "open government licen[sc]e(?: v3 0)?"),
    ("ofl-1.1", .95, "sil", "sil open font licen[sc]e(?: version)?(?: 1 1)?"),
    ("ofl-1.1", .8, "ofl", "scripts sil org ofl"),
    ("ubuntu-font", .9, "ubuntu", "ubuntu font licen[sc]e"),
    ("bitstream-vera", .85, "bitstream", "bitstream vera (?:fonts )?(?:copyright|licen[sc]e)"),
    ("cern-ohl", .9, "cern", "cern open hardware licen[sc]e"),
    ("tapr-ohl", .9, "tapr", "tapr open hardware licen[sc]e"),
    ("solderpad", .9, "solderpad", "solderpad hardware licen[sc]e"),
    ("free-art", .9, "art", "(?:free art licen[sc]e|licence art libre)"),
    ("openrail", .85, "rail", "(?:creativeml )?open ?rail(?: [ms])?(?: licen[sc]e)?"),
    ("llama", .85, "llama", "llama(?: [2-4])? community licen[sc]e"),
    # proprietary and general notices
    ("proprietary", .6, "proprietary", "proprietary and confidential"),
    ("proprietary", .5, "rights", "all rights reserved"),
    ("proprietary", .5, "droits", "tous droits réservés"),
    ("proprietary", .5, "derechos", "todos los derechos reservados"),
    ("proprietary", .5, "rechte", "alle rechte vorbehalten"),
    ("proprietary", .55, "agreement", "end user licen[sc]e agreement"),
    ("proprietary", .5, "unauthorized", "unauthorized (?:copying|use|distribution|reproduction) (?:of this [0-9a-z]+ )?(?:is )?(?:strictly )?prohibited"),
    ("proprietary", .5, "trade", "contains trade secrets"),
    ("non-commercial", .5, "commercial", "(?:for )?non commercial use only"),
    ("non-commercial", .5, "noncommercial", "noncommercial use only"),
    ("evaluation", .5, "evaluation", "for evaluation purposes only"),
    ("academic", .5, "academic", "for academic (?:and research )?use only"),
    ("research", .5, "research", "for research (?:purposes|use) only"),
    ("permission", .4, "permission", "reprinted with permission"),
    ("permission", .4, "permission", "used (?:by|with) permission"),
    ("copyleft", .4, "copyleft", "copyleft"),
    ("free-software", .4, "redistribute", "free software you can redistribute it and or modify it"),
    ("warranty", .3, "warranty", "without (?:any )?warranty of any kind"),
    ("warranty", .3, "warranties", "without warranties or conditions of any kind"),
    ("see-file", .3, "licen", "see (?:the )?(?:file )?licen[sc]e(?: file)? for details"),
]
