"""End-to-end flows built from the operators: the exam lakehouse
(``lakemart.plans.exam``), the games notebook (``lakemart.plans.games``), the
lakehouse runner and the derived exam fixture."""
