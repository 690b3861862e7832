"""Queries over the given tables with their SQL oracles."""


def load_all():
    import importlib
    from checks import registry
    for section in ("tables", "cleaning", "policy", "splitting", "features", "metrics", "thresholds",
                    "risk", "profiling", "scoring", "models", "calibration", "explanation"):
        importlib.import_module(f"checks.section_{section}")
    return registry.QUERIES, registry.ORACLES
