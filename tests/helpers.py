"""Constants and helpers shared by the test modules."""

import os

SF_SMOKE = "/root/testdata/sf0.001"


def write_text(path, name, content):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(content)
