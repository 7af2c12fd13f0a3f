"""The complete job: python -m auditloom INPUT OUTPUT [DATABASE [MAX_REJECTS]]"""

import sys

from auditloom.plans.pipeline import run_full_pipeline
from auditloom.session import build_session


def main(source, output, database=None, max_rejects=0):
    build_session()
    _, summary, seconds = run_full_pipeline(source, output, database=database or None, max_rejects=int(max_rejects))
    for name, value in summary.asDict().items():
        print(f"{name}: {value}")
    print(f"seconds: {seconds:.2f}")


if __name__ == "__main__":
    main(*sys.argv[1:])
