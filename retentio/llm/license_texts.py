"""Texts of known licences.

Short licences are here in full, as published by SPDX, without their copyright
lines; ``short_texts`` gives each with and without its title.  Of long ones there
is (name, first word, words, SHA-256 of the canonical text): the entire text and,
where they stand alone, the terms without title, appendix or instructions.  They
were computed by ``licenses.known_digests`` from the texts as published.
"""

from __future__ import annotations

import re

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{clause}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {holder} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_CLAUSE = "3. Neither the name of the {who} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{kept}.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: Name, titles, text.
_SHORT = (
    ("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)"), _MIT),
    *[("BSD-2-Clause", ("BSD 2-Clause License",), _BSD.format(clause="", holder=h)) for h in ("HOLDER", "OWNER")],
    *[("BSD-3-Clause", ("BSD 3-Clause License",), _BSD.format(clause=_CLAUSE.format(who=w), holder=h))
      for h in ("HOLDER", "OWNER") for w in ("copyright holder", "University")],
    ("ISC", ("ISC License",), _ISC.format(kept=", provided that the above copyright notice and this permission notice appear in all copies")),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD"), _ISC.format(kept="")),
    ("Zlib", ("zlib License",), _ZLIB),
)


def short_texts() -> list[tuple[str, str]]:
    """(name, text): every text alone, with titles and "All rights reserved.", numbered or not."""
    out = []
    for name, titles, text in _SHORT:
        for body in dict.fromkeys((text, re.sub(r"(?m)^[0-9]\. ", "", text))):
            for reserved in ("", "All rights reserved.\n") if name.startswith("BSD") else ("",):
                out += [(name, f"{title}{reserved}{body}") for title in ("", *[t + "\n" for t in titles])]
    return out


DIGESTS: tuple[tuple[str, str, int, str], ...] = (
    ("Apache-2.0", "1", 1375, "6ed6538cc7fd0a1124e46b522494d5714c01a588771995d616b01d7dca4e64fe"),
    ("Apache-2.0", "1", 1380, "de39a9d4f434abcc4c920c7d12dfce3c7d783e3f031da312877d77e585e32c39"),
    ("Apache-2.0", "1", 1406, "9d6ffee88fef15058256aa822373d159664de97cc7f3b5de14dfde903d7278f3"),
    ("Apache-2.0", "1", 1411, "83d450e65487bded604e316138d44bad29b2370fe89c4bea8a4c8bb6427ae8e1"),
    ("Apache-2.0", "1", 1551, "046f2d35b5c1951ff88a93adc5680a42cfeef3bdf5117457e84bea7e2caa9973"),
    ("Apache-2.0", "1", 1582, "6843255c6da96462fa1978c5f75d7bfb585745afbc957f9b8ec4a3950022d7bc"),
    ("Apache-2.0", "apache", 1395, "f16a2c71cdef52763eb4e8d07430ba72c05356a4e2204a12f3995c1ee5d38fde"),
    ("Apache-2.0", "apache", 1400, "bb9623a3f15021216105e0ed4e2426d8ef8863d7c5f58860ef1cd2bf983015cf"),
    ("Apache-2.0", "apache", 1426, "65bfb6f56a10dc6dd6135cf4adeee0f5bc238b3d404067ac48dbf48c0ced3b32"),
    ("Apache-2.0", "apache", 1431, "ed44d69699f98d45c0c3e52ef4574fb05d6045eb6e2cd0e5e3810f6177e87f84"),
    ("Apache-2.0", "apache", 1571, "cc411e5c73676ae13e68bf0fe2c031a62b3a1ef56829577a7d168699686c1e7e"),
    ("Apache-2.0", "apache", 1602, "ef9aa6097e8b8724e8bedf9a9a264cbc3142b55ef97f3c3f079b7aa1aeac425c"),
    ("Apache-2.0", "terms", 1383, "4d6aa515071f3f6f2188c96599b6a575fc0fb402afa0ec1ad84d4f0fabe15cd5"),
    ("Apache-2.0", "terms", 1388, "36bf4bc3f65a3a3715a27446fcc6e075c896e3b75cb615136b59a98da8c2d2c8"),
    ("Apache-2.0", "terms", 1414, "c876a853e3837603a39d56da29306b74786b34411bf636ce5072eb840e764cab"),
    ("Apache-2.0", "terms", 1419, "d8221a4f10c01c6fa5390685929a5ce31d7264a024162fd3dd4d805c57ce0f43"),
    ("Apache-2.0", "terms", 1559, "6e93031c7d61baa616b682b585e2427a8ab8e54b2248ef9e9ccd172bdc4652f3"),
    ("Apache-2.0", "terms", 1590, "e4f2e540d2c4e13a29b650556674e22c46458abf8f8a803515dbc447d9d77ca2"),
    ("Artistic-1.0-Perl", "the", 960, "cc2cd6cccfacd5fb622fb0e9b9a373fa9dcb86a8c152213a2b856dfbe24fe304"),
    ("Artistic-1.0-Perl", "the", 983, "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-3-Clause", "all", 217, "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9"),
    ("BSD-3-Clause", "redistribution", 214, "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "creative", 1088, "0c3e4ca5ed7ced6289d3f5d9a83e4100f9f34d87983b17dc5865376a8a0a98f3"),
    ("GFDL-1.2", "gnu", 3305, "f06741c6c5feec30d99f80228f0d9ea6b884eae0e790ab18a0f4257184befa86"),
    ("GFDL-1.2", "gnu", 3315, "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "gnu", 3710, "80229e90e6f40a551a447f33ef48bd361a8e3166d53f29a2d1537245e2064feb"),
    ("GFDL-1.3", "gnu", 3732, "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "gnu", 1636, "5c47fb5ed4016147baafb020e771d4eb71adefcb6426d6277ea83c2392ad638b"),
    ("GPL-1.0", "gnu", 1641, "2ff62d187f4b86c4c8141ca55213342149784afbac28947615d15cd4a26f90fd"),
    ("GPL-1.0", "gnu", 2067, "efd868a36055ab4add714a45bd15a1b1b817c462c241e8303023daae48e868c9"),
    ("GPL-1.0", "preamble", 1599, "a68751e1d4a26b4af03dc87c73254b2e6900f9a73c647a90cf0854eaa48f6f9d"),
    ("GPL-1.0", "preamble", 1604, "9d181293a375ba07d029d6e9b3a2fe3ce4af77d1fa0387da493c141781eb04a9"),
    ("GPL-1.0", "preamble", 2030, "d73fcc8c7cdc89b60b65c2c369001170252013e8f5de15196155087bf2474678"),
    ("GPL-2.0", "gnu", 2489, "93afb326867f8414151c412905ecf51b64add70a3d5c7481ad59f36512426e15"),
    ("GPL-2.0", "gnu", 2494, "7c18706f760a62d65964b6f8b3846aeed5cde2bd10b6704a255f56e7eb494cbe"),
    ("GPL-2.0", "gnu", 2499, "a07b31e413f005893efb82b73c1664077ccbad48a65bc01513dcfdc8af30d965"),
    ("GPL-2.0", "gnu", 2504, "6682f0d9a5f2b5772c3fa93592f1011da82ec1b9dc4babcf73f7959ac7614e5b"),
    ("GPL-2.0", "gnu", 2965, "0a4ca0a9d0986f9cca44c7a101960554e353775150cd5a8afbeb736694aa9023"),
    ("GPL-2.0", "gnu", 2975, "76a6eea9a03c0408554f9c38efcf1d997fa25b29d14cd2cebb5240975831c64a"),
    ("GPL-2.0", "preamble", 2452, "d8ba368e8b625a165bad2ceb2c9e8378a531376635a03c82f60519fbe425ce32"),
    ("GPL-2.0", "preamble", 2457, "3975e057dcf3dbc18ad2b1a8e1583363161614ce6d91e4029b5ddb7718b0ea1f"),
    ("GPL-2.0", "preamble", 2462, "1a7dace2a21fa73eb7156ca6d6181d091134b2f94f82831fe2914a7d1b6b102a"),
    ("GPL-2.0", "preamble", 2467, "1d43ba9828b8b5b308d815e8be7116591b9dc5ddeb72c2bbfd053cc79214b0c9"),
    ("GPL-2.0", "preamble", 2928, "924d95204068869b67aded56f115208bc1731b0a9ef94125d9883a85fae5463b"),
    ("GPL-2.0", "preamble", 2938, "9e03d19ff9cd632ffa4aaf4774d67e3e1c0a6998deffaf18038abc504c445aa9"),
    ("GPL-3.0", "gnu", 5214, "3d4de016a08e1d98b27dec755cdf4530b92807d97aaa185b32e12d52942b1943"),
    ("GPL-3.0", "gnu", 5219, "3dcf77ad8c25248618918aaff1de8a2cb80cea6ca922ef4a7a389cca96a7560b"),
    ("GPL-3.0", "gnu", 5236, "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("GPL-3.0", "gnu", 5241, "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "gnu", 5662, "f3ab5ee40da170411ea6671f9845ada2aaba303ee57ba6086b373d1e66c9dc3f"),
    ("GPL-3.0", "gnu", 5684, "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0", "preamble", 5186, "06494e7ba863f6a66248455b15f1f1f83e4628ee53111a6f4fd90fabfd14fa59"),
    ("GPL-3.0", "preamble", 5191, "258c99ce300149287e279ba30647d284e65123c1efe38eda7c396f9e9d5c6bf0"),
    ("GPL-3.0", "preamble", 5208, "80d2bf43efa136ac2e7270ccf874f8bcfa290c73ed98846547ea57c88da9dc77"),
    ("GPL-3.0", "preamble", 5213, "fad6d14122ae5943ea05f9e4d48194524a0b701f034fd22c7dded3e6c296c742"),
    ("GPL-3.0", "preamble", 5634, "db49207b2a5a4ea56c8afe44bb10fa7ec004be8062b13f63c03c7b174bf15061"),
    ("GPL-3.0", "preamble", 5656, "1ac3ee43258868524b595aa6806399028b859e6815adb29e1206f809442847d5"),
    ("LGPL-2.0", "gnu", 3825, "e0de5033b5ad2a24c0a1a8b04f09e33038ffa62d2bef7178de2a3c6f5d56f499"),
    ("LGPL-2.0", "gnu", 3830, "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c"),
    ("LGPL-2.0", "gnu", 3860, "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.0", "gnu", 3865, "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "gnu", 4165, "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3"),
    ("LGPL-2.0", "gnu", 4200, "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "preamble", 3763, "802a6bc5cf01b6e1203c282940a051c75be0870d3adc82101dccfce7ac504905"),
    ("LGPL-2.0", "preamble", 3768, "86875a38722956f548be8aaac4a6def4923f749e767d24f82670b219c5b32aa1"),
    ("LGPL-2.0", "preamble", 3798, "5478d5a745a3ab1396a1d5db25a9869a5d318700fcf78f26f687effd8e10df4a"),
    ("LGPL-2.0", "preamble", 3803, "d4689245f0c71022ce729821274153c787fdebe2e92f0de1f6d3c23326a5f619"),
    ("LGPL-2.0", "preamble", 4103, "514a0fb25fe916d1dce454814e8fb7373e674bfeda8e9c33faed7875629d6d39"),
    ("LGPL-2.0", "preamble", 4138, "7b963ffa655dbcc164b6f5a229407c98bdb620d97a461d25ea5f3f30cadf65cf"),
    ("LGPL-2.1", "gnu", 4025, "9bf9c99aeafbdbccd7456a00d574699e3deb41868375496cacbf170be719bebd"),
    ("LGPL-2.1", "gnu", 4030, "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c"),
    ("LGPL-2.1", "gnu", 4060, "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-2.1", "gnu", 4065, "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "gnu", 4366, "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345"),
    ("LGPL-2.1", "gnu", 4401, "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "preamble", 3956, "368fdf0a3d97a758b90b6146ade423561754e31f1540437434047eac2d959e41"),
    ("LGPL-2.1", "preamble", 3961, "446a8adc2da9c55e139c3564c793b6cc9741cfe224e9d47740bda2d268025527"),
    ("LGPL-2.1", "preamble", 3991, "2ef2859ae4577e1d4a14d215abfe8c8b9f6e4ba7dca97a8b81b6c205bf62d7ad"),
    ("LGPL-2.1", "preamble", 3996, "73ac55304afe4c219acdd0cb7683daf4fe3772c9b493da4a095d93a7789311d5"),
    ("LGPL-2.1", "preamble", 4297, "e437340ca45a4a4cff701fa19486eac94cdc5ed6995dec5b53b3c315f4f49868"),
    ("LGPL-2.1", "preamble", 4332, "91fba5fd5007350e2589cef732142c99ceaac0b15c8e36db486ec21766e5c803"),
    ("LGPL-3.0", "gnu", 1231, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "mozilla", 3760, "fbe9a0b96f52e03cb474f9a7083781399c011279e85b548118563ec96e659354"),
    ("MPL-1.1", "mozilla", 3789, "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "mozilla", 2414, "4389b7c80c5d1ae93b31c4594939d7de1a2cd8cbb91d63f692c81d1ebd9cf507"),
    ("MPL-2.0", "mozilla", 2426, "4544af666fc42fe3ea03e86d5db9fef4f4c41c50c15f04550119fdb67822747b"),
)
