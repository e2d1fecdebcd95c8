"""``python -m salesmart <root> <action>``: run one job of the sales pipeline."""

from salesmart.plans.jobs import main

main()
