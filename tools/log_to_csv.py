"""Access log(s) -> CSV rows ``Client,Time,Type,Path,Status,Size`` (no header), as a Spark job.

usage: python tools/log_to_csv.py <log file or folder> <output folder> [master]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparklytics.operators import logs  # noqa: E402
from sparklytics.session import build_session  # noqa: E402
from sparklytics.sources.text import read_lines  # noqa: E402


def convert(spark, src: str, out: str) -> None:
    logs.write_csv(logs.access_log_to_csv(read_lines(spark, src)), out)


def main(argv: list[str]) -> None:
    if len(argv) < 2:
        raise SystemExit(__doc__)
    spark = build_session(master=argv[2] if len(argv) > 2 else None)
    convert(spark, argv[0], argv[1])


if __name__ == "__main__":
    main(sys.argv[1:])
