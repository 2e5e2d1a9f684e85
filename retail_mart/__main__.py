from retail_mart.plans.jobs import main

main()
