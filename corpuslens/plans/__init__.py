from corpuslens.plans.analysis import Settings, analyze, save

__all__ = ["Settings", "analyze", "save"]
