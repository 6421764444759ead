"""Brute-force pieces that several tests use."""

import test_llm_divergence_rules as rules
import test_llm_simhash_tiles as sim


def counts_brute(rows):
    """Ids that the quality rules keep."""
    return {r[0] for r in rules.brute(rows) if r[7]}


def print_groups(rows):
    """The smallest id of each near-duplicate component; rows in order of id."""
    return {rows[g][0] for g in sim.groups([sim.slow_print(t, 3) for _, t in rows], 2)}
