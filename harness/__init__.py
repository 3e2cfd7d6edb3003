"""What the checks and the benchmark share; not part of the product."""
