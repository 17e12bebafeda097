"""Command line: run every stage for one brain and print a JSON summary."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from voxtally.config import load_config, read_yaml
from voxtally.plans.brain_runs import run_brain
from voxtally.session import get_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="voxtally", description=__doc__)
    parser.add_argument("config", help="YAML of one brain")
    parser.add_argument("--defaults", help="YAML of shared defaults")
    parser.add_argument("--output-dir", help="write here instead of paths.output_dir")
    parser.add_argument("--roi", action="append", help="acronym of a region to extract; may be repeated")
    parser.add_argument("--functional-system", help="YAML or JSON with keywords and acronyms for the target summary")
    parser.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
    args = parser.parse_args(argv)
    logging.basicConfig(level=args.log_level, format="%(asctime)s %(levelname)s [%(name)s] %(message)s")
    config = load_config(args.config, args.defaults)
    system = read_yaml(args.functional_system) if args.functional_system else None
    results = run_brain(get_session(), config, args.output_dir, args.roi, system)
    print(json.dumps(results, indent=2, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
