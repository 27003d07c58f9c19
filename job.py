"""spark-submit entry: ``spark-submit --py-files airledger.zip job.py --root ... --servers ...``."""

from airledger.__main__ import main

if __name__ == "__main__":
    main()
