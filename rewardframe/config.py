"""Settings with the defaults the reference's runs and notes use."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ShapingConfig:
    """Reward shaping is on by default."""

    length_penalty_coef: float = 0.01
    repetition_penalty_coef: float = 0.1
    repetition_n_gram: int = 3
    missing_eos_penalty: float | None = 1.0


@dataclass(frozen=True)
class PPOConfig:
    """PPO settings; gamma/lam/clip ranges follow the worked notes."""

    gen_len: int = 32  # padded response width L of the numeric binding
    kl_coef: float = 0.1
    kl_estimator: str = "k1"
    gamma: float = 1.0
    lam: float = 0.95
    cliprange: float = 0.2
    cliprange_value: float = 0.2
    vf_coef: float = 0.1
    whiten_rewards: bool = False
    num_ppo_epochs: int = 2
    mini_batch_size: int = 64
    micro_batch_size: int = 16
    seed: int = 42
    temperature: float = 0.7
    learning_rate: float = 1e-5


SHAPING = ShapingConfig()
PPO = PPOConfig()
