"""DataFrame -> DataFrame operators. None of them triggers a job by itself
unless its docstring says so."""
