"""``python -m loadshift ...`` runs the end-to-end job (see ``loadshift.plans.job``)."""

from .plans.job import main

if __name__ == "__main__":
    main()
