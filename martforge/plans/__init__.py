"""The model graph: staging (M1-M8), roll-ups (M9-M11), marts (M12-M15) and
the full build.  Each model is a function DataFrame(s) -> DataFrame; the
call graph is the dependency graph."""
