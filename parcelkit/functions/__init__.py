"""Column-expression helpers: everything here returns a ``Column`` and
stays inside whole-stage code generation (no Python UDFs)."""
