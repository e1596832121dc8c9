"""Licence signatures, hand-written over normalised words (lower case, one space between words).

One rule a line: kind | label | pattern. A pattern is a regular expression in which a space is a
word boundary. Earlier lines win among rules of one kind. Kinds, from strong to weak: tag (identifier
lines), text (a phrase of the licence itself), grant ("released under"), url, name, short. A detection
that lies inside one of a stronger kind, or inside a longer one of its own kind, is suppressed.
"""

from __future__ import annotations

KINDS = {"tag": (6, 1.0), "text": (5, 0.97), "grant": (4, 0.93), "url": (3, 0.9), "name": (2, 0.8), "short": (1, 0.5)}

#: Fixed values of the query's contract: phrase and label.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

RULES = r"""
tag | agpl-3.0-only | spdx licen[cs]e identifier agpl 3 0( only)?
tag | agpl-3.0-or-later | spdx licen[cs]e identifier agpl 3 0 or later
tag | gpl-2.0-or-later | spdx licen[cs]e identifier gpl 2 0 or later
tag | gpl-2.0-only | spdx licen[cs]e identifier gpl 2 0( only)?
tag | gpl-3.0-or-later | spdx licen[cs]e identifier gpl 3 0 or later
tag | gpl-3.0-only | spdx licen[cs]e identifier gpl 3 0( only)?
tag | lgpl-2.1-or-later | spdx licen[cs]e identifier lgpl 2 1 or later
tag | lgpl-2.1-only | spdx licen[cs]e identifier lgpl 2 1( only)?
tag | lgpl-3.0-or-later | spdx licen[cs]e identifier lgpl 3 0 or later
tag | lgpl-3.0-only | spdx licen[cs]e identifier lgpl 3 0( only)?
tag | apache-2.0 | spdx licen[cs]e identifier apache 2 0
tag | mit-0 | spdx licen[cs]e identifier mit 0
tag | mit | spdx licen[cs]e identifier mit
tag | bsd-2-clause | spdx licen[cs]e identifier bsd 2 clause
tag | bsd-3-clause | spdx licen[cs]e identifier bsd 3 clause
tag | 0bsd | spdx licen[cs]e identifier 0bsd
tag | isc | spdx licen[cs]e identifier isc
tag | zlib | spdx licen[cs]e identifier zlib
tag | mpl-2.0 | spdx licen[cs]e identifier mpl 2 0
tag | mpl-1.1 | spdx licen[cs]e identifier mpl 1 1
tag | epl-2.0 | spdx licen[cs]e identifier epl 2 0
tag | epl-1.0 | spdx licen[cs]e identifier epl 1 0
tag | cddl-1.0 | spdx licen[cs]e identifier cddl 1 [01]
tag | eupl-1.2 | spdx licen[cs]e identifier eupl 1 [12]
tag | bsl-1.0 | spdx licen[cs]e identifier bsl 1 0
tag | busl-1.1 | spdx licen[cs]e identifier busl 1 1
tag | unlicense | spdx licen[cs]e identifier unlicense
tag | wtfpl | spdx licen[cs]e identifier wtfpl
tag | cc0-1.0 | spdx licen[cs]e identifier cc0 1 0
tag | cc-by-4.0 | spdx licen[cs]e identifier cc by 4 0
tag | cc-by-sa-4.0 | spdx licen[cs]e identifier cc by sa 4 0
tag | cc-by-nc-4.0 | spdx licen[cs]e identifier cc by nc 4 0
tag | ofl-1.1 | spdx licen[cs]e identifier ofl 1 1
tag | artistic-2.0 | spdx licen[cs]e identifier artistic 2 0
tag | postgresql | spdx licen[cs]e identifier postgresql
tag | python-2.0 | spdx licen[cs]e identifier (psf|python) 2 0
tag | ncsa | spdx licen[cs]e identifier ncsa
tag | ms-pl | spdx licen[cs]e identifier ms (pl|rl)
tag | upl-1.0 | spdx licen[cs]e identifier upl 1 0
tag | sspl-1.0 | spdx licen[cs]e identifier sspl 1 0
tag | elastic-2.0 | spdx licen[cs]e identifier elastic 2 0
tag | odbl-1.0 | spdx licen[cs]e identifier odbl 1 0
tag | vim | spdx licen[cs]e identifier vim
tag | x11 | spdx licen[cs]e identifier x11
tag | blueoak-1.0.0 | spdx licen[cs]e identifier blueoak 1 0 0
text | mit | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
text | mit | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
text | mit | rights to use copy modify merge publish distribute sublicense and or sell copies of the software
text | mit | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
text | isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
text | postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
text | bsd | redistribution and use in source and binary forms with or without modification are permitted
text | bsd | redistributions of source code must retain the above copyright notice this list of conditions
text | bsd | redistributions in binary form must reproduce the above copyright notice
text | bsd-3-clause | (neither the name|the names?)( \w+){1,12} endorse or promote products derived from this software
text | bsd-4-clause | all advertising materials mentioning features or use of this software must display
text | zlib | the origin of this software must not be misrepresented
text | zlib | altered source versions must be plainly marked as such
text | bsl-1.0 | permission is hereby granted free of charge( \w+){1,20} machine executable object code
text | apache-2.0 | licensed under the apache licen[cs]e version 2 0 the license you may not use this file except in compliance
text | apache-2.0 | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
text | gpl | redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation
text | lgpl | redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation
text | agpl | redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e as published by the free software foundation
text | gpl-2.0-or-later | either version 2 of the licen[cs]e or at your option any later version
text | gpl-3.0-or-later | either version 3 of the licen[cs]e or at your option any later version
text | lgpl-2.1-or-later | either version 2 1 of the licen[cs]e or at your option any later version
text | gpl | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e
text | gpl | everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed
text | mpl-2.0 | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
text | mpl-1.1 | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
text | epl-1.0 | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0
text | epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e (v|version )?2 0
text | cddl-1.0 | the contents of this file are subject to the terms of the common development and distribution licen[cs]e
text | unlicense | this is free and unencumbered software released into the public domain
text | unlicense | anyone is free to copy modify publish use compile sell or distribute this software
text | wtfpl | you just do what the fuck you want to
text | cc0-1.0 | (has|have) dedicated the work to the public domain by waiving all
text | cc-by-4.0 | share copy and redistribute the material in any medium or format adapt remix transform
text | ofl-1.1 | this font software is licensed under the sil open font licen[cs]e version 1 1
text | artistic-2.0 | you are permitted to use and privately modify and distribute( \w+){1,6} standard version
text | ncsa | deal with the software without restriction( \w+){0,30} university of illinois
text | python-2.0 | psf is making python available to licensee on an as is basis
text | openssl | this product includes software developed by the openssl project
text | json | the software shall be used for good not evil
text | beerware | as long as you retain this notice you can do whatever you want with this stuff
text | eupl-1.2 | licensed under the eupl version 1 [12]
text | gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
text | proprietary | (unauthori[sz]ed copying|unauthori[sz]ed use)( \w+){0,12} (strictly prohibited|prohibited)( \w+){0,20} all rights reserved
text | proprietary | (proprietary|confidential)( \w+){0,10} trade secrets?
grant | gpl-1.0-or-later | (licen[cs]ed|released|distributed|available|covered) under( the)?( terms of)?( the)? gnu general public licen[cs]e
grant | gpl-2.0 | (licen[cs]ed|released|distributed|available|covered) under( the)?( terms of)?( the)? gnu general public licen[cs]e (version |v)?2( 0)?
grant | gpl-3.0 | (licen[cs]ed|released|distributed|available|covered) under( the)?( terms of)?( the)? gnu general public licen[cs]e (version |v)?3( 0)?
grant | lgpl | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? gnu (lesser|library) general public licen[cs]e
grant | agpl | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? gnu affero general public licen[cs]e
grant | gpl | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)?( gnu)? gpl
grant | gpl-2.0 | (licen[cs]ed|released|distributed|available) under( the)?( gnu)? gpl ?v?2( 0)?
grant | gpl-3.0 | (licen[cs]ed|released|distributed|available) under( the)?( gnu)? gpl ?v?3( 0)?
grant | apache-2.0 | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? apache( software)? licen[cs]e (version |v)?2( 0)?
grant | apache | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? apache( software)? licen[cs]e
grant | mit | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? (mit|expat)( x11)? licen[cs]e
grant | mit | (mit|expat) licen[cs]ed
grant | bsd-3-clause | (licen[cs]ed|released|distributed|available) under( the| a)? (3|three) clause bsd( style)? licen[cs]e
grant | bsd-3-clause | (licen[cs]ed|released|distributed|available) under( the| a)? bsd (3|three) clause( licen[cs]e)?
grant | bsd-2-clause | (licen[cs]ed|released|distributed|available) under( the| a)? (2|two) clause bsd( style)? licen[cs]e
grant | bsd-2-clause | (licen[cs]ed|released|distributed|available) under( the| a)? bsd (2|two) clause( licen[cs]e)?
grant | bsd | (licen[cs]ed|released|distributed|available) under( the| a)?( new| modified| simplified)? bsd( style)? licen[cs]e
grant | isc | (licen[cs]ed|released|distributed|available) under( the)? isc licen[cs]e
grant | zlib | (licen[cs]ed|released|distributed|available) under( the)? zlib( libpng)? licen[cs]e
grant | mpl-2.0 | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? mozilla public licen[cs]e (version |v)?2( 0)?
grant | mpl | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? mozilla public licen[cs]e
grant | mpl | (licen[cs]ed|released|distributed|available) under( the)? mpl( 2 0)?
grant | epl | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? eclipse public licen[cs]e
grant | cddl | (licen[cs]ed|released|distributed|available) under( the)? cddl
grant | eupl | (licen[cs]ed|released|distributed|available) under( the)? eupl
grant | bsl-1.0 | (licen[cs]ed|released|distributed|available) under( the)? boost software licen[cs]e
grant | unlicense | (licen[cs]ed|released|distributed|available) under( the)? unlicense
grant | public-domain | (released|placed|put|dedicated) (in|into|to) the public domain
grant | cc0-1.0 | (licen[cs]ed|released|distributed|available) under( the)?( creative commons)? cc0( 1 0)?
grant | cc-by-nc-nd-4.0 | (licen[cs]ed|released|distributed|available) under( a| the)?( creative commons)? cc by nc nd 4 0
grant | cc-by-nc-sa-4.0 | (licen[cs]ed|released|distributed|available) under( a| the)?( creative commons)? cc by nc sa 4 0
grant | cc-by-nc-4.0 | (licen[cs]ed|released|distributed|available) under( a| the)?( creative commons)? cc by nc 4 0
grant | cc-by-nd-4.0 | (licen[cs]ed|released|distributed|available) under( a| the)?( creative commons)? cc by nd 4 0
grant | cc-by-sa-4.0 | (licen[cs]ed|released|distributed|available) under( a| the)?( creative commons)? cc by sa 4 0
grant | cc-by-sa-3.0 | (licen[cs]ed|released|distributed|available) under( a| the)?( creative commons)? cc by sa 3 0
grant | cc-by-4.0 | (licen[cs]ed|released|distributed|available) under( a| the)?( creative commons)? cc by 4 0
grant | cc-by-3.0 | (licen[cs]ed|released|distributed|available) under( a| the)?( creative commons)? cc by 3 0
grant | cc-by | (licen[cs]ed|released|distributed|available) under( a| the)? creative commons attribution( \d 0)?( international| unported| generic)?( licen[cs]e)?
grant | cc-by-sa | (licen[cs]ed|released|distributed|available) under( a| the)? creative commons attribution share ?alike( \d 0)?( international| unported)?( licen[cs]e)?
grant | cc-by-nc | (licen[cs]ed|released|distributed|available) under( a| the)? creative commons attribution non ?commercial( \d 0)?( international| unported)?( licen[cs]e)?
grant | ofl-1.1 | (licen[cs]ed|released|distributed|available) under( the)? (sil )?open font licen[cs]e
grant | artistic | (licen[cs]ed|released|distributed|available) under( the)? artistic licen[cs]e
grant | perl | (licen[cs]ed|distributed|redistribute)( \w+){0,12} same terms as perl itself
grant | wtfpl | (licen[cs]ed|released|distributed|available) under( the)? wtfpl
grant | python-2.0 | (licen[cs]ed|released|distributed|available) under( the)? (psf|python( software foundation)?) licen[cs]e
grant | sspl-1.0 | (licen[cs]ed|released|distributed|available) under( the)? server side public licen[cs]e
grant | busl-1.1 | (licen[cs]ed|released|distributed|available) under( the)? business source licen[cs]e
grant | elastic-2.0 | (licen[cs]ed|released|distributed|available) under( the)? elastic licen[cs]e
grant | odbl-1.0 | (licen[cs]ed|released|distributed|available) under( the)? open database licen[cs]e
grant | gfdl | (licen[cs]ed|released|distributed|available) under( the)?( terms of)?( the)? gnu free documentation licen[cs]e
url | apache-2.0 | (https? )?(www )?apache org licenses license 2 0( html| txt)?
url | gpl-2.0 | (https? )?(www )?gnu org licenses( old licenses)? gpl 2 0( \w+)?
url | gpl-3.0 | (https? )?(www )?gnu org licenses gpl 3 0( \w+)?
url | gpl | (https? )?(www )?gnu org (licenses|copyleft)( gpl)?( html)?
url | lgpl-2.1 | (https? )?(www )?gnu org licenses( old licenses)? lgpl 2 1( \w+)?
url | lgpl-3.0 | (https? )?(www )?gnu org licenses lgpl 3 0( \w+)?
url | lgpl | (https? )?(www )?gnu org licenses lgpl( \w+)?
url | agpl-3.0 | (https? )?(www )?gnu org licenses agpl 3 0( \w+)?
url | gfdl | (https? )?(www )?gnu org licenses fdl( \w+)?
url | mit | (https? )?(www )?opensource org licenses? mit( license)?( \w+)?
url | bsd-2-clause | (https? )?(www )?opensource org licenses? bsd 2 clause
url | bsd-3-clause | (https? )?(www )?opensource org licenses? bsd 3 clause
url | bsd | (https? )?(www )?opensource org licenses? bsd license( \w+)?
url | isc | (https? )?(www )?opensource org licenses? isc
url | artistic-2.0 | (https? )?(www )?opensource org licenses? artistic license 2 0
url | osi | (https? )?(www )?opensource org licenses?
url | mpl-2.0 | (https? )?(www )?mozilla org mpl 2 0
url | mpl-1.1 | (https? )?(www )?mozilla org mpl( mpl)? 1 1( html)?
url | epl-1.0 | (https? )?(www )?eclipse org legal epl v10( html)?
url | epl-2.0 | (https? )?(www )?eclipse org legal epl (v20|2 0)( html)?
url | bsl-1.0 | (https? )?(www )?boost org license 1 0 txt
url | unlicense | (https? )?(www )?unlicense org
url | wtfpl | (https? )?(www )?wtfpl net
url | cc0-1.0 | (https? )?(www )?creativecommons org publicdomain zero 1 0
url | public-domain | (https? )?(www )?creativecommons org publicdomain mark 1 0
url | cc-by-4.0 | (https? )?(www )?creativecommons org licenses by 4 0
url | cc-by-3.0 | (https? )?(www )?creativecommons org licenses by 3 0
url | cc-by-2.0 | (https? )?(www )?creativecommons org licenses by 2 [05]
url | cc-by-sa-4.0 | (https? )?(www )?creativecommons org licenses by sa 4 0
url | cc-by-sa-3.0 | (https? )?(www )?creativecommons org licenses by sa 3 0
url | cc-by-nc-4.0 | (https? )?(www )?creativecommons org licenses by nc 4 0
url | cc-by-nc-sa-4.0 | (https? )?(www )?creativecommons org licenses by nc sa 4 0
url | cc-by-nc-nd-4.0 | (https? )?(www )?creativecommons org licenses by nc nd 4 0
url | cc-by-nd-4.0 | (https? )?(www )?creativecommons org licenses by nd 4 0
url | ofl-1.1 | (https? )?(scripts )?sil org ofl
url | odbl-1.0 | (https? )?(www )?opendatacommons org licenses odbl
url | pddl-1.0 | (https? )?(www )?opendatacommons org licenses pddl
name | gpl-2.0 | gnu general public licen[cs]e (version |v)?2( 0)?
name | gpl-3.0 | gnu general public licen[cs]e (version |v)?3( 0)?
name | gpl | gnu general public licen[cs]e
name | gpl | gnu gpl
name | lgpl-2.0 | gnu library general public licen[cs]e
name | lgpl-2.1 | gnu lesser general public licen[cs]e (version |v)?2 1
name | lgpl-3.0 | gnu lesser general public licen[cs]e (version |v)?3( 0)?
name | lgpl | gnu lesser general public licen[cs]e
name | agpl-3.0 | gnu affero general public licen[cs]e (version |v)?3( 0)?
name | agpl | (gnu )?affero general public licen[cs]e
name | gfdl | gnu free documentation licen[cs]e
name | apache-1.1 | apache( software)? licen[cs]e (version |v)?1 1
name | apache-2.0 | apache( software)? licen[cs]e (version |v)?2( 0)?
name | apache | apache( software)? licen[cs]e
name | mit | (mit|expat) licen[cs]e
name | x11 | (mit )?x11 licen[cs]e
name | bsd-2-clause | (2|two) clause bsd( licen[cs]e)?
name | bsd-2-clause | (simplified|freebsd) bsd licen[cs]e
name | bsd-3-clause | (3|three) clause bsd( licen[cs]e)?
name | bsd-3-clause | (new|modified|revised) bsd licen[cs]e
name | bsd-4-clause | (original|old|4 clause|four clause) bsd licen[cs]e
name | bsd | bsd( style)? licen[cs]e
name | 0bsd | (zero clause bsd|bsd zero clause)( licen[cs]e)?
name | isc | isc licen[cs]e
name | zlib | zlib( libpng)? licen[cs]e
name | mpl-2.0 | mozilla public licen[cs]e (version |v)?2( 0)?
name | mpl-1.1 | mozilla public licen[cs]e (version |v)?1 1
name | mpl | mozilla public licen[cs]e
name | epl-1.0 | eclipse public licen[cs]e (version |v)?1 0
name | epl-2.0 | eclipse public licen[cs]e (version |v)?2( 0)?
name | epl | eclipse public licen[cs]e
name | cpl-1.0 | common public licen[cs]e( version 1 0)?
name | cddl | common development and distribution licen[cs]e
name | eupl | european union public licen[cs]e
name | bsl-1.0 | boost software licen[cs]e( version)?( 1 0)?
name | unlicense | the unlicense
name | wtfpl | (do what the fuck you want to public licen[cs]e|wtfpl)
name | cc0-1.0 | cc0( 1 0)?( universal)?
name | cc-by-4.0 | cc by 4 0
name | cc-by-3.0 | cc by 3 0
name | cc-by-2.0 | cc by 2 [05]
name | cc-by-sa-4.0 | cc by sa 4 0
name | cc-by-sa-3.0 | cc by sa 3 0
name | cc-by-sa | cc by sa
name | cc-by-nc-4.0 | cc by nc 4 0
name | cc-by-nc-sa-4.0 | cc by nc sa 4 0
name | cc-by-nc-sa | cc by nc sa
name | cc-by-nc-nd-4.0 | cc by nc nd 4 0
name | cc-by-nc-nd | cc by nc nd
name | cc-by-nc | cc by nc
name | cc-by-nd | cc by nd( 4 0)?
name | cc-by | cc by
name | cc-by-nc-sa | creative commons attribution non ?commercial share ?alike( \d 0)?
name | cc-by-nc-nd | creative commons attribution non ?commercial no ?deriv(ative)?s( \d 0)?
name | cc-by-nc | creative commons attribution non ?commercial( \d 0)?
name | cc-by-sa | creative commons attribution share ?alike( \d 0)?
name | cc-by-nd | creative commons attribution no ?deriv(ative)?s( \d 0)?
name | cc-by | creative commons attribution( \d 0)?
name | cc | creative commons licen[cs]e
name | ofl-1.1 | (sil )?open font licen[cs]e
name | artistic-1.0 | artistic licen[cs]e (version )?1 0
name | artistic-2.0 | artistic licen[cs]e (version )?2 0
name | artistic | artistic licen[cs]e
name | postgresql | postgresql licen[cs]e
name | python-2.0 | (python software foundation|psf) licen[cs]e
name | ruby | ruby licen[cs]e
name | php-3.01 | php licen[cs]e( version 3 01)?
name | openssl | openssl licen[cs]e
name | ncsa | (university of illinois )?ncsa( open source)? licen[cs]e
name | ms-pl | microsoft public licen[cs]e
name | ms-rl | microsoft reciprocal licen[cs]e
name | upl-1.0 | universal permissive licen[cs]e
name | osl-3.0 | open software licen[cs]e( version| v)?( 3 0)?
name | afl-3.0 | academic free licen[cs]e( version| v)?( 3 0)?
name | sspl-1.0 | server side public licen[cs]e
name | busl-1.1 | business source licen[cs]e
name | elastic-2.0 | elastic licen[cs]e( 2 0)?
name | odbl-1.0 | open database licen[cs]e
name | odc-by-1.0 | open data commons attribution licen[cs]e
name | pddl-1.0 | public domain dedication and licen[cs]e
name | vim | vim licen[cs]e
name | json | json licen[cs]e
name | beerware | beer ?ware licen[cs]e
name | blueoak-1.0.0 | blue oak model licen[cs]e
name | ibm-ipl | ibm public licen[cs]e
name | npl | netscape public licen[cs]e
name | qpl-1.0 | q public licen[cs]e
name | ecl-2.0 | educational community licen[cs]e
name | openrail | (creativeml )?(open )?rail( m)? licen[cs]e
name | llama | llama( \d)? community licen[cs]e
name | proprietary | all rights reserved
short | agpl | agpl( ?v?3( 0)?)?
short | lgpl | lgpl( ?v?[23]( [01])?)?
short | gpl-2.0 | gplv2
short | gpl-3.0 | gplv3
short | gpl | gpl( \d( 0)?)?
short | mpl-2.0 | mpl 2 0
short | cddl | cddl( 1 [01])?
short | eupl | eupl( 1 [12])?
short | asl-2.0 | asl 2 0
short | public-domain | public domain
short | licence-mention | under the terms of (the|this) licen[cs]e
"""


def load() -> list[tuple[str, str, str]]:
    """(kind, label, pattern)"""
    rules = []
    for line in RULES.strip().splitlines():
        kind, label, pattern = (x.strip() for x in line.split(" | ", 2))
        rules.append((kind, label, pattern))
    return rules
