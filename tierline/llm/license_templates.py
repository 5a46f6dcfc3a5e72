"""Licence notices by family: the labelled table of the licence classifier.

Fixed values: short public notices and the opening sentences of public licence
texts, as they are usually quoted.
"""

from __future__ import annotations

TEMPLATES: dict[str, list[str]] = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "isc": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "Dedicated to the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form "
        "or by any means without the prior written permission of the publisher.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
        "Copyright. All rights reserved.",
        "All rights reserved.",
    ],
}

# Paragraphs that use the words of licences without being one.
ORDINARY = [
    "The driver showed the license to the officer and went on under the bridge.",
    "A public license was issued by the city for the new general store.",
    "The terms of the agreement were read to the members of the board.",
    "You may not use this door after nine in the evening.",
    "Version 2.0 of the report is available and version 3 is out next year.",
    "The software is provided with the machine and the manual.",
    "Permission to enter the public garden is granted by the general manager.",
    "The work was released under the name of the author in the spring.",
    "The library is open to any person with a card, free of charge.",
    "Rights and duties of the public are the subject of this work.",
    "Copies of the map are sold without restriction at the station.",
    "MIT and Apache are names, and so are Mozilla and Creative Commons.",
    "The copyright law of the country was changed by the general court.",
    "The general public was invited to the lesser hall of the town.",
]

# Licences outside the families, and sentences that only speak of licences:
# unknown, too. The second list is held out for the calibration.
OTHER = [
    "SPDX-License-Identifier: BSL-1.0",
    "SPDX-License-Identifier: EUPL-1.2",
    "SPDX-License-Identifier: EPL-2.0",
    "SPDX-License-Identifier: WTFPL",
    "SPDX-License-Identifier: Artistic-2.0",
    "SPDX-License-Identifier: NONE",
    "Licensed under the Eclipse Public License, Version 2.0.",
    "Licensed under the European Union Public Licence, Version 1.2.",
    "Licensed under the Boost Software License, Version 1.0.",
    "Released under the Business Source License 1.1.",
    "Licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Common Public Attribution License, Version 1.0.",
    "The Apache License and the GNU General Public License differ in their patent clauses.",
    "The Mozilla Public License stands between the MIT License and the GNU General Public License.",
    "We compared the MIT License with the BSD License and the Apache License, Version 2.0.",
    "This is not released under the MIT License.",
    "This work is not licensed under the GNU General Public License, version 2.",
    "Was it not licensed under the Apache License, Version 2.0? It is not.",
    "It was never licensed under the Apache License, Version 2.0.",
    "This was never released under the BSD License.",
    "It is no longer licensed under the Mozilla Public License, Version 2.0.",
    "It is no longer released under the MIT License.",
    "Nothing here is released under the BSD License.",
    "All rights reserved? No.",
    "Are all rights reserved? No, some are not.",
    "Not all rights reserved here.",
    "Copyright is one thing. All rights reserved? No more.",
    "A copy of the GNU General Public License hung on the wall of the office.",
    "She wrote a book about the GNU Lesser General Public License and the public domain.",
    "Creative Commons and the public domain were the subject of the talk.",
]
OTHER_HELD_OUT = [
    "SPDX-License-Identifier: Zlib",
    "SPDX-License-Identifier: OFL-1.1",
    "Licensed under the Eclipse Public License 1.0.",
    "Licensed under the Artistic License 2.0.",
    "Released under the zlib License.",
    "This work is licensed under a licence of its own, version 2.0.",
    "Unlike the GNU General Public License, the Apache License does not ask for the source.",
    "The code is not licensed under the MIT License.",
    "It was not released under the BSD License, as some believed.",
    "The file was never licensed under the GNU General Public License, version 2.",
    "The book is no longer licensed under the Apache License, Version 2.0.",
    "Not all rights reserved, only some.",
    "Rights? All rights reserved? No, none.",
    "The court asked what the Creative Commons Attribution License means.",
]
