"""Fixed values of the licence scan: short public licence texts, their titles, names and
phrases of one-line notices, equivalent spellings, digests of longer texts."""

# Spellings taken as one, other form first.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "noncommercial": "non commercial", "acknowledgement": "acknowledgment", "organisation": "organization",
    "organisations": "organizations", "favour": "favor", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "judgement": "judgment", "labour": "labor", "whilst": "while", "wilful": "willful", "owners": "owner",
    "holders": "holder", "contributors": "contributor", "v": "version", "gnu gpl": "gnu general public license",
}

# Phrases that open a one-line notice.
PHRASES = ["licensed under", "released under", "distributed under", "available under", "provided under",
           "this work is licensed under", "this software is licensed under", "this file is licensed under",
           "this project is licensed under", "licensed under the terms of", "released under the terms of",
           "distributed under the terms of", "SPDX-License-Identifier:"]

# Names under which a licence is given.
NAMES = {
    "MIT": ["MIT License", "MIT", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL v2", "GPLv2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL v3", "GPLv3", "GPL-3.0"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL v3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL v3", "AGPL-3.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause", "New BSD License"],
    "ISC": ["ISC License", "ISC"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"],
    "Zlib": ["zlib License", "Zlib"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0", "CC0"],
    "CC-BY-4.0": ["CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "CC-BY-NC-4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "CC-BY-ND-4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"],
}

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Licence texts, without their titles and copyright lines.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
""" + _BSD_TAIL,
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}

# Titles that may stand above the texts.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
}

# Digests of the canonical form of longer licence texts; where a text ends with
# advice on how to apply it, also the digest without that.
DIGESTS = {
    "Apache-2.0": ["e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2",
                   "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0"],
    "GPL-2.0": ["72b4215107895cc5d84fa72777e9663242c462bbf98ca94191cb3717b79fcbd8",
                "c802f4144a5611206e1040fee65faa6e3f3eb8d890b58a6c2fbe32e204b91acc"],
    "GPL-3.0": ["c81796d45bdf662f6744225ecfed2c317b1db3ef01e19f3abdd4fb01b8e6d425",
                "3826cf4e8fa63f01ed9000e1f267117fc976d8e63a682a8f570e24fa0432f860"],
    "LGPL-3.0": ["af4f466bab5554afad60c219ff8bf29eddb00df6ef0f1fcf73fa05ad4b3289f5"],
    "MPL-2.0": ["4b2a8d7c7a2aa71545835298cfb85f8e7b2b7c8e4fa7ead922e269f9b2bf1920"],
    "CC0-1.0": ["8ad9eb1c16457f53d804f0a521fcaa7957418d41d3c10aabb2f434cbb19e56a8"],
    "BSD-3-Clause": ["3cffcba4fceb117a1a736cb6c30b91e6b22de9afec2e1123b0c8c7a756f915f4"],
}

# Lines of standard headers that name their licence.
HEADERS = {
    "Apache-2.0": ['Licensed under the Apache License, Version 2.0 (the "License");',
                   'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except',
                   'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   'compliance with the License.'],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
