"""Imports every query module so the registry is complete."""

from __future__ import annotations

from .registry import REGISTRY, Query


def registry() -> dict[str, Query]:
    from . import q_docs, q_events, q_logs, q_long, q_misc, q_ppo, q_ranks, q_rlvr  # noqa: F401

    return REGISTRY
