"""Signature rules of the licence scan: one hand-written regular expression a line.

A rule is ``label | priority | strength | keyword | regular expression``.  It is matched on a text's words in
lower case, one space apart (a word is ASCII letters and digits, or characters beyond ASCII), and
always covers whole words.  The keyword is in every match; texts without it never meet the expression.
Priorities: 5 machine-readable tags, 4 addresses and whole notices, 3 names with a version, 2 names,
1 short or loose mentions.  The strength is the chance in percent that a match is a licence statement.
Within a priority the order of the lines decides between equal matches.
"""

RULES = r"""
apache-1.0 | 5 | 99 | spdx license identifier apache | spdx license identifier apache 1 0
apache-1.1 | 5 | 99 | spdx license identifier apache | spdx license identifier apache 1 1
apache-2.0 | 5 | 99 | spdx license identifier apache | spdx license identifier apache 2 0
mit | 5 | 99 | spdx license identifier mit | spdx license identifier mit
mit-0 | 5 | 99 | spdx license identifier mit 0 | spdx license identifier mit 0
bsd-2-clause | 5 | 99 | spdx license identifier bsd | spdx license identifier bsd 2 clause( patent| views)?
bsd-3-clause | 5 | 99 | spdx license identifier bsd | spdx license identifier bsd 3 clause( clear| attribution| lbnl)?
bsd-4-clause | 5 | 99 | spdx license identifier bsd | spdx license identifier bsd 4 clause
0bsd | 5 | 99 | spdx license identifier 0bsd | spdx license identifier 0bsd
isc | 5 | 99 | spdx license identifier isc | spdx license identifier isc
gpl-1.0 | 5 | 99 | spdx license identifier gpl | spdx license identifier gpl 1 0( only| or later)?
gpl-2.0 | 5 | 99 | spdx license identifier gpl | spdx license identifier gpl 2 0( only)?
gpl-2.0-or-later | 5 | 99 | spdx license identifier gpl | spdx license identifier gpl 2 0 or later
gpl-3.0 | 5 | 99 | spdx license identifier gpl | spdx license identifier gpl 3 0( only)?
gpl-3.0-or-later | 5 | 99 | spdx license identifier gpl | spdx license identifier gpl 3 0 or later
lgpl-2.0 | 5 | 99 | spdx license identifier lgpl | spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.1 | 5 | 99 | spdx license identifier lgpl | spdx license identifier lgpl 2 1( only| or later)?
lgpl-3.0 | 5 | 99 | spdx license identifier lgpl | spdx license identifier lgpl 3 0( only| or later)?
agpl-3.0 | 5 | 99 | spdx license identifier agpl | spdx license identifier agpl 3 0( only| or later)?
mpl-1.1 | 5 | 99 | spdx license identifier mpl | spdx license identifier mpl 1 1
mpl-2.0 | 5 | 99 | spdx license identifier mpl | spdx license identifier mpl 2 0( no copyleft exception)?
epl-1.0 | 5 | 99 | spdx license identifier epl | spdx license identifier epl 1 0
epl-2.0 | 5 | 99 | spdx license identifier epl | spdx license identifier epl 2 0
cddl-1.0 | 5 | 99 | spdx license identifier cddl | spdx license identifier cddl 1 [01]
eupl-1.2 | 5 | 99 | spdx license identifier eupl | spdx license identifier eupl 1 [0-2]
bsl-1.0 | 5 | 99 | spdx license identifier bsl | spdx license identifier bsl 1 0
busl-1.1 | 5 | 99 | spdx license identifier busl | spdx license identifier busl 1 1
cc0-1.0 | 5 | 99 | spdx license identifier cc0 | spdx license identifier cc0 1 0
cc-by | 5 | 99 | spdx license identifier cc by | spdx license identifier cc by \d \d
cc-by-sa | 5 | 99 | spdx license identifier cc by sa | spdx license identifier cc by sa \d \d
cc-by-nc | 5 | 99 | spdx license identifier cc by nc | spdx license identifier cc by nc \d \d
cc-by-nd | 5 | 99 | spdx license identifier cc by nd | spdx license identifier cc by nd \d \d
cc-by-nc-sa | 5 | 99 | spdx license identifier cc by nc sa | spdx license identifier cc by nc sa \d \d
cc-by-nc-nd | 5 | 99 | spdx license identifier cc by nc nd | spdx license identifier cc by nc nd \d \d
unlicense | 5 | 99 | spdx license identifier unlicense | spdx license identifier unlicense
wtfpl | 5 | 99 | spdx license identifier wtfpl | spdx license identifier wtfpl
zlib | 5 | 99 | spdx license identifier zlib | spdx license identifier zlib
ofl-1.1 | 5 | 99 | spdx license identifier ofl | spdx license identifier ofl 1 1
artistic-2.0 | 5 | 99 | spdx license identifier artistic | spdx license identifier artistic 2 0
postgresql | 5 | 99 | spdx license identifier postgresql | spdx license identifier postgresql
apache-2.0 | 4 | 97 | apache org licenses license 2 0 | (https? )?(www )?apache org licenses license 2 0( txt| html)?
apache-1.1 | 4 | 97 | apache org licenses license 1 1 | (https? )?(www )?apache org licenses license 1 1
apache-2.0 | 4 | 98 | you may not use this file except in compliance with the license | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
mit | 4 | 97 | opensource org licenses mit | (https? )?(www )?opensource org licenses mit( license)?( php| html)?
mit | 4 | 98 | permission is hereby granted free of charge to any person obtaining a copy of | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files( the software)?
bsd-2-clause | 4 | 97 | opensource org licenses bsd 2 clause | (https? )?(www )?opensource org licenses bsd 2 clause
bsd-3-clause | 4 | 97 | opensource org licenses bsd 3 clause | (https? )?(www )?opensource org licenses bsd 3 clause
bsd | 4 | 97 | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-4-clause | 4 | 95 | all advertising materials mentioning features | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3-clause | 4 | 95 | may be used to endorse or promote products | neither the name of( \S+){1,12}? may be used to endorse or promote products( derived from this software)?
isc | 4 | 97 | permission to use copy modify and or distribute this software | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
gpl | 4 | 95 | gnu org licenses gpl | (https? )?(www )?gnu org licenses gpl( html| txt)?
gpl-2.0 | 4 | 97 | gnu org licenses | (https? )?(www )?gnu org licenses (old licenses )?gpl 2 0( html| txt)?
gpl-3.0 | 4 | 97 | gnu org licenses gpl 3 0 | (https? )?(www )?gnu org licenses gpl 3 0( html| txt)?
lgpl | 4 | 95 | gnu org licenses lgpl | (https? )?(www )?gnu org licenses lgpl( [23] [01])?( html| txt)?
agpl-3.0 | 4 | 97 | gnu org licenses agpl | (https? )?(www )?gnu org licenses agpl( 3 0)?( html| txt)?
gfdl | 4 | 95 | gnu org licenses fdl | (https? )?(www )?gnu org licenses fdl( 1 [123])?( html| txt)?
gpl | 4 | 95 | redistribute it and or modify it under the terms of the gnu general public license | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation
lgpl | 4 | 95 | redistribute it and or modify it under the terms of the gnu | you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license as published by the free software foundation
agpl | 4 | 95 | redistribute it and or modify it under the terms of the gnu affero | you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation
mpl-2.0 | 4 | 97 | mozilla org mpl 2 0 | (https? )?(www )?mozilla org mpl 2 0
mpl-2.0 | 4 | 98 | subject to the terms of the mozilla public license | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | 4 | 97 | subject to the mozilla public license version 1 1 | the contents of this file are subject to the mozilla public license version 1 1
epl-2.0 | 4 | 97 | eclipse org legal epl 2 0 | (https? )?(www )?eclipse org legal epl 2 0( html)?
epl-1.0 | 4 | 97 | eclipse org legal epl v10 | (https? )?(www )?eclipse org legal epl v10( html)?
cc0-1.0 | 4 | 97 | creativecommons org publicdomain zero | (https? )?(www )?creativecommons org publicdomain zero 1 0
public-domain | 4 | 95 | creativecommons org publicdomain mark | (https? )?(www )?creativecommons org publicdomain mark 1 0
cc-by | 4 | 96 | creativecommons org licenses by | (https? )?(www )?creativecommons org licenses by( \d \d)?
cc-by-sa | 4 | 96 | creativecommons org licenses by sa | (https? )?(www )?creativecommons org licenses by sa( \d \d)?
cc-by-nc | 4 | 96 | creativecommons org licenses by nc | (https? )?(www )?creativecommons org licenses by nc( \d \d)?
cc-by-nd | 4 | 96 | creativecommons org licenses by nd | (https? )?(www )?creativecommons org licenses by nd( \d \d)?
cc-by-nc-sa | 4 | 96 | creativecommons org licenses by nc sa | (https? )?(www )?creativecommons org licenses by nc sa( \d \d)?
cc-by-nc-nd | 4 | 96 | creativecommons org licenses by nc nd | (https? )?(www )?creativecommons org licenses by nc nd( \d \d)?
unlicense | 4 | 98 | free and unencumbered software released into the public domain | this is free and unencumbered software released into the public domain
unlicense | 4 | 96 | unlicense org | (https? )?(www )?unlicense org
wtfpl | 4 | 96 | wtfpl net | (https? )?(www )?wtfpl net
bsl-1.0 | 4 | 97 | boost org license 1 0 | (https? )?(www )?boost org license 1 0( txt)?
zlib | 4 | 96 | in no event will the authors be held liable for any damages arising from the use of this software | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
ofl-1.1 | 4 | 96 | scripts sil org ofl | (https? )?(www )?scripts sil org ofl
odbl-1.0 | 4 | 96 | opendatacommons org licenses odbl | (https? )?(www )?opendatacommons org licenses odbl( 1 0| summary)?
odc-by-1.0 | 4 | 96 | opendatacommons org licenses by | (https? )?(www )?opendatacommons org licenses by( 1 0| summary)?
pddl-1.0 | 4 | 96 | opendatacommons org licenses pddl | (https? )?(www )?opendatacommons org licenses pddl( 1 0| summary)?
beerware | 4 | 96 | beer in return | as long as you retain this notice you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it you can buy me a beer in return
json | 4 | 96 | shall be used for good not evil | the software shall be used for good not evil
proprietary | 4 | 90 | no part of this | no part of this (publication|book|work|document|software|material|website) may be (reproduced|copied|distributed|transmitted|used)
proprietary | 4 | 90 | unauthori | unauthori[sz]ed (copying|use|reproduction|distribution)( \S+){0,12}? strictly (prohibited|forbidden)
proprietary | 4 | 85 | proprietary | (this \S+ (is|contains) )?(confidential and proprietary|proprietary and confidential)( information)?( of \S+)?
apache-2.0 | 3 | 95 | apache | (licensed |released |distributed |available )?(under )?(the )?(terms of )?(the )?apache (software )?licen[sc]e (version |v )?2( 0)?
apache-1.1 | 3 | 93 | apache | (the )?apache (software )?licen[sc]e (version |v )?1 1
apache-1.0 | 3 | 93 | apache | (the )?apache (software )?licen[sc]e (version |v )?1 0
apache-2.0 | 3 | 85 | apache 2 0 | (licensed under )?(the )?apache 2 0( licen[sc]e)?
mit | 3 | 92 | mit | (licensed|released|distributed|available|published) under (the )?(terms of )?(the )?mit( x11| expat)? licen[sc]e
mit-0 | 3 | 93 | mit no attribution | (the )?mit no attribution( licen[sc]e)?
x11 | 3 | 90 | x11 | (the )?(mit )?x11 licen[sc]e
bsd-2-clause | 3 | 93 | bsd | (the )?(simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd)( licen[sc]e)?
bsd-2-clause | 3 | 90 | freebsd licen | (the )?freebsd licen[sc]e
bsd-3-clause | 3 | 93 | bsd | (the )?(new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)( licen[sc]e)?
bsd-4-clause | 3 | 93 | bsd | (the )?(original bsd|old bsd|bsd 4 clause|4 clause bsd|four clause bsd)( licen[sc]e)?
0bsd | 3 | 93 | bsd | (the )?(zero clause bsd|bsd zero clause|0 clause bsd)( licen[sc]e)?
gpl-1.0 | 3 | 92 | general public licen | (gnu )?general public licen[sc]e (gpl )?(version |v )?1( 0)?
gpl-2.0 | 3 | 93 | general public licen | (licensed under )?(the )?(terms of the )?(gnu )?general public licen[sc]e (gpl )?(version |v )?2( 0)?
gpl-2.0-or-later | 3 | 94 | general public licen | (licensed under )?(the )?(terms of the )?(gnu )?general public licen[sc]e (gpl )?(version |v )?2( 0)? or( at your option)?( any)? (later|newer)( versions?)?
gpl-3.0 | 3 | 93 | general public licen | (licensed under )?(the )?(terms of the )?(gnu )?general public licen[sc]e (gpl )?(version |v )?3( 0)?
gpl-3.0-or-later | 3 | 94 | general public licen | (licensed under )?(the )?(terms of the )?(gnu )?general public licen[sc]e (gpl )?(version |v )?3( 0)? or( at your option)?( any)? (later|newer)( versions?)?
gpl-2.0 | 3 | 88 | gpl | (gnu )?(gplv2|gpl v2|gpl 2( 0)?|gpl version 2)( only)?
gpl-2.0-or-later | 3 | 90 | gpl | (gnu )?(gplv2|gpl v2|gpl 2( 0)?|gpl version 2) or later
gpl-3.0 | 3 | 88 | gpl | (gnu )?(gplv3|gpl v3|gpl 3( 0)?|gpl version 3)( only)?
gpl-3.0-or-later | 3 | 90 | gpl | (gnu )?(gplv3|gpl v3|gpl 3( 0)?|gpl version 3) or later
lgpl-2.0 | 3 | 93 | general public licen | (gnu )?library general public licen[sc]e (lgpl )?(version |v )?2( 0)?
lgpl-2.1 | 3 | 93 | general public licen | (gnu )?lesser general public licen[sc]e (lgpl )?(version |v )?2 1( or( any)? later( version)?)?
lgpl-3.0 | 3 | 93 | general public licen | (gnu )?lesser general public licen[sc]e (lgpl )?(version |v )?3( 0)?( or( any)? later( version)?)?
lgpl-2.1 | 3 | 88 | lgpl | (gnu )?(lgplv2 1|lgpl v2 1|lgpl 2 1)( or later)?
lgpl-3.0 | 3 | 88 | lgpl | (gnu )?(lgplv3|lgpl v3|lgpl 3( 0)?)( or later)?
agpl-3.0 | 3 | 93 | affero general public licen | (gnu )?affero general public licen[sc]e (agpl )?(version |v )?3( 0)?( or( any)? later( version)?)?
agpl-1.0 | 3 | 93 | affero general public licen | affero general public licen[sc]e (version |v )?1( 0)?
agpl-3.0 | 3 | 88 | agpl | (gnu )?(agplv3|agpl v3|agpl 3( 0)?)( or later)?
gfdl-1.1 | 3 | 92 | free documentation licen | (gnu )?free documentation licen[sc]e (version )?1 1( or( any)? later( version)?)?
gfdl-1.2 | 3 | 92 | free documentation licen | (gnu )?free documentation licen[sc]e (version )?1 2( or( any)? later( version)?)?
gfdl-1.3 | 3 | 92 | free documentation licen | (gnu )?free documentation licen[sc]e (version )?1 3( or( any)? later( version)?)?
mpl-1.0 | 3 | 92 | mozilla public licen | mozilla public licen[sc]e (mpl )?(version |v )?1 0
mpl-1.1 | 3 | 92 | mozilla public licen | mozilla public licen[sc]e (mpl )?(version |v )?1 1
mpl-2.0 | 3 | 92 | mozilla public licen | mozilla public licen[sc]e (mpl )?(version |v )?2( 0)?
epl-1.0 | 3 | 92 | eclipse public licen | eclipse public licen[sc]e (epl )?(version |v )?1( 0)?
epl-2.0 | 3 | 92 | eclipse public licen | eclipse public licen[sc]e (epl )?(version |v )?2( 0)?
edl-1.0 | 3 | 92 | eclipse distribution licen | eclipse distribution licen[sc]e (version |v )?1( 0)?
cpl-1.0 | 3 | 92 | common public licen | common public licen[sc]e (version |v )?1( 0)?
ipl-1.0 | 3 | 92 | ibm public licen | ibm public licen[sc]e (version |v )?1( 0)?
cddl-1.0 | 3 | 92 | common development and distribution licen | common development and distribution licen[sc]e (cddl )?(version |v )?1( 0)?
cddl-1.1 | 3 | 92 | common development and distribution licen | common development and distribution licen[sc]e (cddl )?(version |v )?1 1
eupl-1.1 | 3 | 92 | european union public licen | european union public licen[sc]e (eupl )?(version |v )?1 1
eupl-1.2 | 3 | 92 | european union public licen | european union public licen[sc]e (eupl )?(version |v )?1 2
artistic-1.0 | 3 | 92 | artistic licen | (the )?artistic licen[sc]e (version |v )?1( 0)?
artistic-2.0 | 3 | 92 | artistic licen | (the )?artistic licen[sc]e (version |v )?2( 0)?
php-3.0 | 3 | 90 | php licen | (the )?php licen[sc]e (version |v )?3( 0)?
php-3.01 | 3 | 90 | php licen | (the )?php licen[sc]e (version |v )?3 01
bsl-1.0 | 3 | 92 | boost software licen | boost software licen[sc]e (version |v )?1( 0)?
afl-2.1 | 3 | 90 | academic free licen | academic free licen[sc]e (version |v )?2 [01]
afl-3.0 | 3 | 90 | academic free licen | academic free licen[sc]e (version |v )?3( 0)?
osl-2.1 | 3 | 90 | open software licen | open software licen[sc]e (version |v )?2 [01]
osl-3.0 | 3 | 90 | open software licen | open software licen[sc]e (version |v )?3( 0)?
lppl-1.3 | 3 | 90 | latex project public licen | latex project public licen[sc]e (version |v )?1 3[abc]?
ofl-1.0 | 3 | 90 | open font licen | (sil )?open font licen[sc]e (ofl )?(version |v )?1 0
ofl-1.1 | 3 | 90 | open font licen | (sil )?open font licen[sc]e (ofl )?(version |v )?1 1
cecill-2.1 | 3 | 90 | cecill | cecill (free software licen[sc]e agreement )?(version |v )?2( [01])?
cecill-b | 3 | 90 | cecill b | cecill b( licen[sc]e)?
cecill-c | 3 | 90 | cecill c | cecill c( licen[sc]e)?
mulan-psl-2 | 3 | 90 | mulan | mulan (psl|permissive software licen[sc]e) (version |v)?2
cc0-1.0 | 3 | 93 | cc0 | (creative commons )?cc0( 1 0)?( universal)?
cc-by-2.0 | 3 | 92 | cc by 2 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by 2 0
cc-by-2.5 | 3 | 92 | cc by 2 5 | (licensed |released )?(under )?(a )?(creative commons )?cc by 2 5
cc-by-3.0 | 3 | 92 | cc by 3 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by 3 0
cc-by-4.0 | 3 | 92 | cc by 4 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by 4 0
cc-by-sa-2.0 | 3 | 92 | cc by sa 2 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by sa 2 0
cc-by-sa-2.5 | 3 | 92 | cc by sa 2 5 | (licensed |released )?(under )?(a )?(creative commons )?cc by sa 2 5
cc-by-sa-3.0 | 3 | 92 | cc by sa 3 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by sa 3 0
cc-by-sa-4.0 | 3 | 92 | cc by sa 4 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by sa 4 0
cc-by-nc-2.0 | 3 | 92 | cc by nc 2 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nc 2 0
cc-by-nc-3.0 | 3 | 92 | cc by nc 3 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nc 3 0
cc-by-nc-4.0 | 3 | 92 | cc by nc 4 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nc 4 0
cc-by-nd-3.0 | 3 | 92 | cc by nd 3 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nd 3 0
cc-by-nd-4.0 | 3 | 92 | cc by nd 4 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nd 4 0
cc-by-nc-sa-3.0 | 3 | 92 | cc by nc sa 3 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nc sa 3 0
cc-by-nc-sa-4.0 | 3 | 92 | cc by nc sa 4 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nc sa 4 0
cc-by-nc-nd-3.0 | 3 | 92 | cc by nc nd 3 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nc nd 3 0
cc-by-nc-nd-4.0 | 3 | 92 | cc by nc nd 4 0 | (licensed |released )?(under )?(a )?(creative commons )?cc by nc nd 4 0
cc-by | 3 | 92 | creative commons attribution | creative commons attribution( \d \d)?( international| unported| generic)?( public)?( licen[sc]e)?
cc-by-sa | 3 | 93 | creative commons attribution share | creative commons attribution share ?alike( \d \d)?( international| unported| generic)?( public)?( licen[sc]e)?
cc-by-nc | 3 | 93 | creative commons attribution non | creative commons attribution non ?commercial( \d \d)?( international| unported| generic)?( public)?( licen[sc]e)?
cc-by-nd | 3 | 93 | creative commons attribution no | creative commons attribution no ?deriv(ative)?s( \d \d)?( international| unported| generic)?( public)?( licen[sc]e)?
cc-by-nc-sa | 3 | 94 | creative commons attribution non | creative commons attribution non ?commercial share ?alike( \d \d)?( international| unported| generic)?( public)?( licen[sc]e)?
cc-by-nc-nd | 3 | 94 | creative commons attribution non | creative commons attribution non ?commercial no ?deriv(ative)?s( \d \d)?( international| unported| generic)?( public)?( licen[sc]e)?
sspl-1.0 | 3 | 92 | server side public licen | server side public licen[sc]e( sspl)?( version 1| v1)?
busl-1.1 | 3 | 92 | business source licen | business source licen[sc]e( version)?( 1 1)?
elastic-2.0 | 3 | 92 | elastic licen | elastic licen[sc]e( version)?( v2| 2 0)?
polyform-noncommercial | 3 | 92 | polyform | polyform noncommercial( licen[sc]e)?( 1 0 0)?
polyform-small-business | 3 | 92 | polyform | polyform small business( licen[sc]e)?( 1 0 0)?
openrail-m | 3 | 90 | openrail | (creativeml |bigscience |bigcode )?openrail( m)?( licen[sc]e)?
llama-community | 3 | 90 | llama | llama (\d (\d )?)?community licen[sc]e( agreement)?
odbl-1.0 | 3 | 92 | open database licen | (odc )?open database licen[sc]e( odbl)?( v1 0| 1 0)?
odc-by-1.0 | 3 | 92 | open data commons attribution licen | open data commons attribution licen[sc]e( v1 0| 1 0)?
pddl-1.0 | 3 | 92 | public domain dedication and licen | (odc )?public domain dedication and licen[sc]e( pddl)?( 1 0)?
ogl-uk-3.0 | 3 | 92 | open government licen | open government licen[sc]e (version |v)?3( 0)?
ms-pl | 3 | 90 | microsoft public licen | microsoft public licen[sc]e( ms pl)?
ms-rl | 3 | 90 | microsoft reciprocal licen | microsoft reciprocal licen[sc]e( ms rl)?
mit | 2 | 85 | mit | (the )?mit licen[sc]e
mit | 2 | 80 | expat licen | (the )?expat licen[sc]e
apache | 2 | 80 | apache | (the )?apache (software )?licen[sc]e
bsd | 2 | 80 | bsd | (the )?bsd( style)? licen[sc]e
isc | 2 | 85 | isc licen | (the )?isc licen[sc]e
gpl | 2 | 85 | general public licen | (the )?(gnu )?general public licen[sc]e
lgpl | 2 | 87 | general public licen | (the )?(gnu )?(lesser|library) general public licen[sc]e
agpl | 2 | 87 | affero general public licen | (the )?(gnu )?affero general public licen[sc]e
gfdl | 2 | 85 | free documentation licen | (the )?(gnu )?free documentation licen[sc]e
mpl | 2 | 85 | mozilla public licen | (the )?mozilla public licen[sc]e
epl | 2 | 85 | eclipse public licen | (the )?eclipse public licen[sc]e
cpl | 2 | 80 | common public licen | (the )?common public licen[sc]e
cddl | 2 | 85 | common development and distribution licen | (the )?common development and distribution licen[sc]e
eupl | 2 | 85 | european union public licen | (the )?european union public licen[sc]e
artistic | 2 | 80 | artistic licen | (the )?artistic licen[sc]e
artistic-or-gpl | 2 | 85 | same terms as perl | (under )?the same terms as perl( itself)?
python | 2 | 85 | python | (the )?python (software foundation )?licen[sc]e( agreement)?
psf-2.0 | 2 | 85 | psf licen | (the )?psf licen[sc]e( agreement)?
ruby | 2 | 80 | ruby licen | (the )?ruby licen[sc]e
php | 2 | 80 | php licen | (the )?php licen[sc]e
zlib | 2 | 85 | zlib | (the )?zlib( libpng)? licen[sc]e
libpng | 2 | 85 | libpng licen | (the )?libpng licen[sc]e
openssl | 2 | 85 | openssl licen | (the )?openssl licen[sc]e
postgresql | 2 | 85 | postgresql licen | (the )?postgresql licen[sc]e
vim | 2 | 80 | vim licen | (the )?vim licen[sc]e
curl | 2 | 80 | curl licen | (the )?curl licen[sc]e
w3c | 2 | 85 | w3c software | (the )?w3c software (notice and )?licen[sc]e
ncsa | 2 | 85 | ncsa | (university of illinois )?(ncsa )?open source licen[sc]e ncsa|ncsa open source licen[sc]e
unicode | 2 | 80 | unicode | unicode (inc )?licen[sc]e( agreement)?
ijg | 2 | 80 | independent jpeg group | independent jpeg group( s)?( licen[sc]e)?
ftl | 2 | 85 | freetype | (the )?freetype (project )?licen[sc]e
upl-1.0 | 2 | 85 | universal permissive licen | (the )?universal permissive licen[sc]e( v 1 0)?
sleepycat | 2 | 85 | sleepycat licen | (the )?sleepycat licen[sc]e
qpl-1.0 | 2 | 85 | q public licen | (the )?q public licen[sc]e( version 1 0)?
lppl | 2 | 85 | latex project public licen | (the )?latex project public licen[sc]e
ofl | 2 | 85 | open font licen | (the )?(sil )?open font licen[sc]e
ubuntu-font | 2 | 85 | ubuntu font licen | (the )?ubuntu font licen[sc]e
blueoak-1.0.0 | 2 | 85 | blue oak model licen | (the )?blue oak model licen[sc]e( 1 0 0)?
hippocratic | 2 | 85 | hippocratic licen | (the )?hippocratic licen[sc]e( \d \d)?
commons-clause | 2 | 85 | commons clause | (the )?commons clause( licen[sc]e)?( condition)?( v1 0)?
beerware | 2 | 80 | beerware | (the )?beerware( licen[sc]e)?
beerware | 2 | 80 | beer ware | (the )?beer ware( licen[sc]e)?
wtfpl | 2 | 90 | what the fuck you want to public licen | (the )?do what the fuck you want to public licen[sc]e
unlicense | 2 | 80 | unlicense | (the )?unlicense
ogl-uk | 2 | 85 | open government licen | (the )?open government licen[sc]e
creative-commons | 2 | 75 | creative commons | (under )?(a )?creative commons( public)?( licen[sc]e)?
gpl | 2 | 85 | gpl | licensed under (the )?(gnu )?gpl
lgpl | 2 | 85 | lgpl | licensed under (the )?(gnu )?lgpl
public-domain | 2 | 80 | public domain | (released |dedicated |placed |published )?(in |into |to )?the public domain
reserved | 2 | 80 | rights | (all|some) rights( are)? reserved
no-rights-reserved | 2 | 80 | no rights reserved | no rights reserved
gpl | 2 | 85 | licence publique générale | licence publique générale( gnu| limitée)?
gpl | 2 | 85 | licencia pública general | licencia pública general( de)?( gnu)?
gpl | 2 | 85 | öffentliche lizenz | allgemeine öffentliche lizenz
reserved | 2 | 80 | tous droits | tous droits (de reproduction )?(réservés|reserves)
reserved | 2 | 80 | alle rechte vorbehalten | alle rechte vorbehalten
reserved | 2 | 80 | derechos reservados | (todos los )?derechos reservados
reserved | 2 | 80 | diritti riservati | (tutti i )?diritti riservati
reserved | 2 | 80 | direitos reservados | (todos os )?direitos reservados
cc-by | 2 | 80 | cc by | cc by
cc-by-sa | 2 | 85 | cc by sa | cc by sa
cc-by-nc | 2 | 85 | cc by nc | cc by nc
cc-by-nd | 2 | 85 | cc by nd | cc by nd
cc-by-nc-sa | 2 | 85 | cc by nc sa | cc by nc sa
cc-by-nc-nd | 2 | 85 | cc by nc nd | cc by nc nd
commercial | 1 | 50 | commercial licen | (a )?commercial licen[sc]e( agreement)?
eula | 1 | 60 | end user licen | end user licen[sc]e agreement
gpl | 1 | 50 | gpl | (gnu )?gpl
lgpl | 1 | 50 | lgpl | (gnu )?lgpl
agpl | 1 | 50 | agpl | (gnu )?agpl
copyright | 1 | 40 | copyright | copyright( c)? (19|20)\d\d( (19|20)\d\d)*
copyright | 1 | 35 | © | ©((19|20)\d\d| (19|20)\d\d)?
license-file | 1 | 45 | licen | see (the )?(file )?licen[sc]e( file| txt| md)*( for (more )?(details|information|terms))?
license-file | 1 | 45 | copying | see (the )?(file )?copying( file| txt| md)*( for (more )?(details|information|terms))?
unspecified | 1 | 30 | licensed under | licensed under
"""
