"""Short licence texts and the usual one-line notices, by identifier."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

GPL3_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program. If not, see <https://www.gnu.org/licenses/>."""

KNOWN = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Zlib", ZLIB),
    ("Zlib", "zlib License\n\n" + ZLIB),
    ("Apache-2.0", APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", GPL3_HEADER),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)

# Further notices of one line.
NOTICES = (
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "This work is licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "This work is licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "Released under the GNU General Public License, version 2."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "Released under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "Released under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-1.1", "Licensed under the Mozilla Public License, version 1.1."),
    ("MPL-1.1", "Released under the Mozilla Public License, version 1.1."),
    ("MPL-1.1", "This work is licensed under the Mozilla Public License, version 1.1."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "Released under the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-1.1", "SPDX-License-Identifier: MPL-1.1"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-ND-4.0", "SPDX-License-Identifier: CC-BY-ND-4.0"),
    ("CC-BY-NC-SA-4.0", "SPDX-License-Identifier: CC-BY-NC-SA-4.0"),
    ("CC-BY-NC-ND-4.0", "SPDX-License-Identifier: CC-BY-NC-ND-4.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
)

# Digests of the canonical form of full texts, those of /usr/share/common-licenses of Debian,
# the Unlicense, and BSD with and without a title and numbers. Where a text ends its terms
# with a line of its own, also without what follows, and without that line.
FULL_TEXTS = (
    ("Apache-2.0", "34c508ac7089932978b3a6f692aa3c4adfe5006150950885692bebd83c59a34f"),
    ("Apache-2.0", "35e94baa4754da544fe27f4cc4eeebf9430709d08c5f93b21cf42331d9aa0b2b"),
    ("Apache-2.0", "7e95e745723af9ae32e72f4f298aab41c09468dfb29f0e35cf86fdec836ede2b"),
    ("Artistic-1.0-Perl", "ddb49d591ecc4f65a223b9f53f330918100c323532a653c090d21b38e35a3a42"),
    ("BSD-2-Clause", "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2"),
    ("BSD-2-Clause", "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-2-Clause", "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9"),
    ("BSD-2-Clause", "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b"),
    ("BSD-3-Clause", "326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("BSD-3-Clause-UC", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "de4b88a2c819a4661af54f735069ed878216da8b4992b919b84afa18cfc0e54c"),
    ("GFDL-1.2", "37db86be8f16e9b8dfb0d63e1698ad2e07d54f312494c1cb2dbdb4fa37487f0f"),
    ("GFDL-1.3", "7befa86e5ee53162018d597eee81db6c727f3e64fab4641af93e19deab1807b4"),
    ("GPL-1.0", "74d0cd23803c9754c36f6ca0e1af411b418ed6b6564e757472bf0d870a1b5d1b"),
    ("GPL-1.0", "9caf042595280548f0149ac88169a7f2e04f35b2a642cf00b991f00d48bfa4ce"),
    ("GPL-1.0", "af30c0af27b90ec812acdb040f3dcc944a87cd893456690efe35063f39e3eeeb"),
    ("GPL-2.0", "178d586a448701f01712744f9de166175b5625d05f71dd532a3d694e2b935def"),
    ("GPL-2.0", "ae49934a47b15ec36e1ce1eb7504b3439c29f0e9be2ed0f60ba20ad7124dcb7c"),
    ("GPL-2.0", "c230c00f329737cb7ce3d97a266318b4c9d4c1fd321335e592b2ce1112179b88"),
    ("GPL-3.0", "59a779feaae4de539260be3c8adb19c287a771586d211e12d93932777da37349"),
    ("GPL-3.0", "f37d587507fc579524cb06d1130d5899891a978ee008cfc033b3b4d95da28bee"),
    ("GPL-3.0", "f7bb29d9a31c3a1a68ccff0d8d9053350dc0b10b52b62d46d0f2e36a41e32975"),
    ("LGPL-2.0", "b4114daa3dfa52e27e78b2c4e17acd58bf4381e812762f4ded0bcb8eabd1092c"),
    ("LGPL-2.0", "e0de5033b5ad2a24c0a1a8b04f09e33038ffa62d2bef7178de2a3c6f5d56f499"),
    ("LGPL-2.0", "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c"),
    ("LGPL-2.1", "294fb9ec58649c7eb0cf90fc2900ac1b28b82fb6da9d40d7599d6b7d399d4d2e"),
    ("LGPL-2.1", "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c"),
    ("LGPL-2.1", "9bf9c99aeafbdbccd7456a00d574699e3deb41868375496cacbf170be719bebd"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "f7acdbee0d4664d81de2d7cd8ed816ec6b9a21e93ce84fb85ed3b6ec5ce41094"),
    ("MPL-2.0", "cdb5877b9b73b693216820ac5a0090510c6fd9df7c38876e551b865cce774ddd"),
    ("Unlicense", "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd"),
)
