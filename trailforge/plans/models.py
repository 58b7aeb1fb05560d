"""Catalogue of base models: look-up, and the command that trains one."""

from __future__ import annotations

from trailforge.functions.constants import MODELS

_FIELDS = ("size", "model_name", "parameters", "memory_gb", "gpu", "min_gpu_memory", "lora_r", "lora_alpha", "batch_size", "gradient_accumulation")


def model_config(size: str) -> dict:
    """Settings of a size; an unknown one is an error that names the known ones."""
    for m in MODELS:
        if m[0] == size:
            return dict(zip(_FIELDS, m, strict=True))
    raise ValueError(f"unknown model size {size!r}; known are {', '.join(m[0] for m in MODELS)}")


def training_command(size: str, dataset: str, output: str, golden_set: str | None = None, config: str | None = None, use_wandb: bool = False) -> str:
    m = model_config(size)
    parts: list[tuple[str, object]] = [
        ("--model-name", m["model_name"]), ("--model-size", size), ("--dataset", dataset), ("--output-dir", output), ("--lora-r", m["lora_r"]),
        ("--lora-alpha", m["lora_alpha"]), ("--batch-size", m["batch_size"]), ("--gradient-accumulation-steps", m["gradient_accumulation"]), ("--use-4bit", None),
    ]
    parts += [(k, v) for k, v in (("--golden-set", golden_set), ("--config", config)) if v is not None]
    parts += [("--use-wandb", None)] * use_wandb
    return " ".join(["python3 llama_train.py", *(k if v is None else f"{k} {v}" for k, v in parts)])
